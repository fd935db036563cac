"""Mix sources to target weights by iterative proportional fitting, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querytrail.llm.quality import words
from querytrail.session import store

OTHER = "*"
#: Sweeps in one plan; more make planning slow.
SWEEPS_PER_JOB = 3
Targets = dict[str, dict[str, float]]


def token_count(text: Column) -> Column:
    """Words of the whole text; a text without words counts as one token."""
    return F.greatest(F.size(words(text)), F.lit(1)).cast("long")


def _target(dimension: str, weights: dict[str, float]) -> Column:
    """Target weight of a class."""
    expression = F
    for name, weight in weights.items():
        expression = expression.when(F.col(dimension) == name, float(weight))
    return expression.otherwise(0.0)


def rake(
    cells: DataFrame, targets: Targets, budget: float, sweeps: int = 12, keep_other: bool = False,
) -> DataFrame:
    """Adds `share`: each cell's share of the mixture.

    `cells` has one row per combination of classes with its `tokens`. Shares start in proportion to
    tokens; each sweep scales them to the target marginals one dimension after the other, then
    limits each cell to the tokens it has under the budget. Targets of classes without tokens are
    spread over the others. With `keep_other`, `OTHER` has its share of all tokens as target where it
    is given none, and the targets share the rest. The table has at most one row per combination of targets, whatever the
    corpus, so it is one partition and its windows need no shuffle.
    """
    cells = cells.coalesce(1)
    whole = Window.partitionBy(F.lit(1))
    cells = cells.withColumn("share", F.col("tokens") / F.sum("tokens").over(whole))
    cells = cells.withColumn("_most", F.col("share") / budget)
    for dimension, weights in targets.items():
        once = F.row_number().over(Window.partitionBy(dimension).orderBy("tokens", *targets)) == 1
        cells = cells.withColumn("_once", F.when(once, _target(dimension, weights)).otherwise(0.0))
        cells = cells.withColumn(
            f"_to_{dimension}", F.coalesce(F.try_divide(
                _target(dimension, weights), F.sum("_once").over(whole)), F.lit(0.0))).drop("_once")
        if keep_other and OTHER not in weights:
            other = F.col(dimension) == OTHER
            held = F.sum(F.when(other, F.col("share")).otherwise(0.0)).over(whole)
            cells = cells.withColumn(f"_to_{dimension}", F.when(other, held).otherwise(
                F.col(f"_to_{dimension}") * (1.0 - held)))
    for sweep in range(sweeps):
        if sweep % SWEEPS_PER_JOB == 0:
            cells = store(cells, "raked").coalesce(1)
        for dimension in targets:
            held = F.sum("share").over(Window.partitionBy(dimension))
            cells = cells.withColumn("share", F.coalesce(
                F.try_divide(F.col("share") * F.col(f"_to_{dimension}"), held), F.lit(0.0)))
        cells = cells.withColumn("share", F.least("share", "_most"))
    return cells.drop("_most", *[f"_to_{d}" for d in targets])


def draw(id_column: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed only."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(
    docs: DataFrame, targets: Targets, classes: dict[str, Column], id_column: str = "doc_id",
    text_column: str = "text", fraction: float = 0.8, sweeps: int = 12, seed: str = "mix",
    keep_other: bool = False,
) -> DataFrame:
    """All rows and columns with `tokens`, the class of each dimension as `<dimension>_class`,
    `probability` and `sampled`.

    `targets` gives each dimension's classes and target weights, `OTHER` for all remaining values and
    nulls; a class without a target, or with target 0, is not drawn. With `keep_other`, values that are not
    listed and nulls keep their share of all tokens in dimensions without a target for `OTHER`. The mixture holds about
    `fraction` of all tokens; a cell that has fewer tokens than its share is taken whole. Whether a
    row is drawn depends on its id, so repeated rows share their fate, and null ids too. Rows are
    drawn, never repeated. Input columns named like the added ones are replaced.
    """
    names = {d: f"{d}_class" for d in targets}
    added = ("tokens", *names.values(), "probability", "sampled")
    base = [c for c in docs.columns if c not in added]
    rows = docs.select(*base, token_count(F.col(text_column)).alias("tokens"), *[
        F.when(classes[d].isin([v for v in targets[d] if v != OTHER]), classes[d])
        .otherwise(F.lit(OTHER)).alias(names[d]) for d in targets])
    by_name = {names[d]: targets[d] for d in targets}
    cells = store(rows.groupBy(*by_name).agg(F.sum("tokens").alias("tokens")), "cells")
    raked = rake(cells, by_name, fraction, sweeps, keep_other)
    total = F.sum("tokens").over(Window.partitionBy(F.lit(1)))
    rates = store(raked.select(
        *[F.col(n).alias(f"_{n}") for n in by_name],
        F.least(F.lit(1.0), F.col("share") * fraction * total / F.col("tokens")).alias("probability")), "rates")
    matched = [F.col(n) == F.col(f"_{n}") for n in by_name]
    # At most one row per combination of targets.
    mixed = rows.join(F.broadcast(rates), matched, "left")
    return mixed.select(
        *base, "tokens", *by_name, F.round("probability", 9).alias("probability"),
        (draw(F.col(id_column), seed) < F.round("probability", 9)).alias("sampled"))


# Targets of the registered query: even sources, languages and topics by hand.
TARGETS: Targets = {
    "source": {f"src{i}": 1 / 20 for i in range(20)},
    "lang": {"en": 0.5, "de": 0.2, "fr": 0.18, "es": 0.12},
    "topic": {"general": 0.85, "legal": 0.05, "technical": 0.1},
}


def topic(text: Column) -> Column:
    """Topic of a text from words that give it away."""
    text = F.coalesce(text, F.lit(""))
    legal = text.contains("icense") | text.contains("ights reserved") | text.contains("opyright")
    technical = text.contains("http") | text.contains("@") | text.contains("=")
    return F.when(legal, "legal").when(technical, "technical").otherwise("general")


def classes_of_documents() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.col("text"))}


def check_sql(fraction: float = 0.8, sweeps: int = 12, seed: str = "mix") -> str:
    """The same over `documents`, for a plain SQL engine: every sweep is three windows in a row."""
    def values(dimension: str) -> str:
        return ", ".join(f"('{k}', CAST({v!r} AS DOUBLE))" for k, v in TARGETS[dimension].items())

    steps, held = [], "started"
    for sweep in range(sweeps):
        for d in TARGETS:
            steps.append(
                f"s{sweep}_{d} AS (SELECT * REPLACE (share * to_{d} / sum(share) OVER (PARTITION BY {d}_class)"
                f" AS share) FROM {held})")
            held = f"s{sweep}_{d}"
        steps.append(f"s{sweep} AS (SELECT * REPLACE (least(share, most) AS share) FROM {held})")
        held = f"s{sweep}"
    known = {d: ", ".join(f"'{k}'" for k in TARGETS[d]) for d in TARGETS}
    targets = ", ".join(
        f"t_{d} AS (SELECT name, w / sum(w) OVER () AS w FROM (VALUES {values(d)}) v(name, w)"
        f" WHERE name IN (SELECT {d}_class FROM cells))" for d in TARGETS)
    return f"""
    WITH docs AS (
      SELECT doc_id, source, lang, greatest(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')), 1)
               AS tokens,
             CASE WHEN text LIKE '%icense%' OR text LIKE '%ights reserved%' OR text LIKE '%opyright%'
                  THEN 'legal'
                  WHEN text LIKE '%http%' OR text LIKE '%@%' OR text LIKE '%=%' THEN 'technical'
                  ELSE 'general' END AS topic
      FROM documents),
    classed AS (
      SELECT *, CASE WHEN source IN ({known['source']}) THEN source ELSE '*' END AS source_class,
             CASE WHEN lang IN ({known['lang']}) THEN lang ELSE '*' END AS lang_class,
             topic AS topic_class
      FROM docs),
    cells AS (
      SELECT source_class, lang_class, topic_class, sum(tokens) AS tokens FROM classed GROUP BY ALL),
    {targets},
    started AS (
      SELECT c.*, c.tokens / sum(c.tokens) OVER () AS share,
             c.tokens / sum(c.tokens) OVER () / {fraction} AS most,
             coalesce(ts.w, 0) AS to_source, coalesce(tl.w, 0) AS to_lang, coalesce(tt.w, 0) AS to_topic
      FROM cells c LEFT JOIN t_source ts ON ts.name = source_class
      LEFT JOIN t_lang tl ON tl.name = lang_class LEFT JOIN t_topic tt ON tt.name = topic_class),
    {', '.join(steps)},
    rates AS (
      SELECT source_class, lang_class, topic_class,
             round(least(1.0, share * {fraction} * sum(tokens) OVER () / tokens), 9) AS probability
      FROM {held})
    SELECT doc_id, source, lang, CAST(tokens AS BIGINT) AS tokens, source_class, lang_class, topic_class,
           probability,
           CAST(('0x' || substr(md5('{seed}:' || doc_id), 1, 13)) AS UBIGINT) / 4503599627370496.0
             < probability AS sampled
    FROM classed JOIN rates USING (source_class, lang_class, topic_class)
    """
