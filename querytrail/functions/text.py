"""String expressions; all of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed at both ends by the two trims that the inputs went through.
CONTROL_AND_BLANK = "".join(chr(c) for c in range(0x21))
UNICODE_BLANK = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_control(c: Column) -> Column:
    """Strip every character up to U+0020 (Spark's own trim strips blanks only)."""
    return F.btrim(c, F.lit(CONTROL_AND_BLANK))


def trim_blank(c: Column) -> Column:
    """Strip Unicode white space."""
    return F.btrim(c, F.lit(UNICODE_BLANK))


def is_blank(c: Column) -> Column:
    return F.coalesce(trim_blank(c), F.lit("")) == ""


def clean_line_ends(c: Column) -> Column:
    return trim_control(F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")))


def half_up_2(x: Column) -> Column:
    """Two decimals as floor(x * 100 + 0.5) / 100 on doubles."""
    return F.floor(x * F.lit(100.0) + F.lit(0.5)).cast("double") / F.lit(100.0)


def percentage(part: Column, whole: Column) -> Column:
    """Part of whole in percent with two decimals; 0 for an empty whole."""
    ratio = part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * F.lit(100.0)
    return F.coalesce(half_up_2(ratio), F.lit(0.0))


def without_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def json_name(name: Column) -> Column:
    return F.replace(name, F.lit(".txt"), F.lit(".json"))


def failed_label(file: Column, number: Column, statement: Column) -> Column:
    """Report line of a failed statement: its id and its first 100 characters."""
    return F.concat(
        file, F.lit("_query_"), number.cast("string"), F.lit(": "),
        F.substring(statement, 1, 100), F.lit("..."),
    )


def contains_ci(c: Column, pattern: str) -> Column:
    """Case-insensitive regex search; null is no match."""
    return F.coalesce(c.rlike(f"(?i){pattern}"), F.lit(False))


def quoted_list(c: Column) -> Column:
    """A printed list of quoted names (['a', 'b']) as an array; null when it is not one."""
    return F.from_json(c, "array<string>", {"allowBackslashEscapingAnyCharacter": "true"})


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def iso_timestamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


# --- parse-tree labels --------------------------------------------------------------------

RULE_MARK = "RuleContext: "
TERMINAL_MARK = "Terminal: "
UNNAMED = "unknown"


def node_kind(node_type: Column) -> Column:
    return (
        F.when(node_type.startswith(RULE_MARK), "rule")
        .when(node_type.startswith(TERMINAL_MARK), "terminal")
        .otherwise("other")
    )


def rule_name(node_type: Column) -> Column:
    return F.when(
        node_type.startswith(RULE_MARK), F.replace(node_type, F.lit(RULE_MARK), F.lit(""))
    ).otherwise(UNNAMED)


def token_name(node_type: Column) -> Column:
    return F.when(
        node_type.startswith(TERMINAL_MARK), F.replace(node_type, F.lit(TERMINAL_MARK), F.lit(""))
    ).otherwise(UNNAMED)


def class_name(node_type: Column) -> Column:
    return (
        F.when(node_type.startswith(RULE_MARK), F.concat(rule_name(node_type), F.lit("Context")))
        .when(node_type.startswith(TERMINAL_MARK), "TerminalNodeImpl")
        .otherwise("UnknownContext")
    )


def literal_name(type_name: Column) -> Column:
    """Token type name without the outer quotes of a literal."""
    return F.regexp_replace(type_name, r"(?s)^'(.*)'\z", "$1")
