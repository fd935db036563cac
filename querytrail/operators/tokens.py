"""Token lists of a whole corpus as one token table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querytrail.functions.ordered import BITS, look_around
from querytrail.schemas import END_OF_FILE, TOKEN, TOKEN_DEFAULTS
from querytrail.sources.texts import DEEP_JSON

RANGE_BITS = 10
# Of so many blocks of ranges the planner need not be told: beyond that they are shuffled, whatever their files' size.
BROADCAST_BLOCKS = 200_000
# The filter of blocks: this many bits a block or up to twice as many, in parts of 2^15 bits, three bits each; 64 MB at most.
BITS_A_BLOCK, PART_BITS, MARKS, MOST_PARTS = 16, 15, 3, 1 << 14
NEAR = "_near"


def read_tokens(documents: DataFrame, nested: bool = False) -> DataFrame:
    """One row per token with its place `pos` in the list; missing fields get their defaults.

    Read by Spark's JSON reader: the deep tree beside the list is skipped, not built. `nested` gives the
    documents with their lists as read, in a column `tokens`, for a step that takes both of a document
    where it is.
    """
    layout = T.StructType([T.StructField("tokenStream", T.ArrayType(TOKEN))])
    read = F.from_json("payload", layout, DEEP_JSON)["tokenStream"]
    if nested:
        return documents.select("file", "payload", read.alias("tokens"))
    listed = documents.select("file", read.alias("t"))
    # the outer form: a plain explode makes Spark parse each document once more for a filter
    rows = listed.select("file", F.posexplode_outer("t").alias("pos", "t")).filter("pos is not null")

    def field(name: str) -> Column:
        return F.coalesce(F.col(f"t.{name}"), F.lit(TOKEN_DEFAULTS[name]))

    return rows.select(
        "file", "pos", field("index").alias("index"), field("type").alias("type"),
        field("typeName").alias("type_name"), field("text").alias("text"),
        field("startIndex").alias("start_index"), field("stopIndex").alias("stop_index"),
        field("line").alias("line"), field("column").alias("column"),
        field("channel").alias("channel"),
    )


def rejected_token_lists(documents: DataFrame) -> DataFrame:
    """(file, reason) of documents whose token list is lost: broken text, or a list of another shape.

    Documents without a token list are none of these.
    """
    layout = T.StructType([T.StructField("tokenStream", T.ArrayType(TOKEN))])
    loose = T.StructType([T.StructField("tokenStream", T.StringType())])
    read = documents.select(
        "file", F.from_json("payload", layout, DEEP_JSON)["tokenStream"].alias("t"),
        F.from_json("payload", loose, DEEP_JSON)["tokenStream"].alias("s"),
        F.try_parse_json("payload").isNull().alias("broken"))
    shape = F.col("s").isNotNull() & F.col("t").isNull()
    return read.filter(shape | F.col("broken")).select(
        "file", F.when(F.col("broken"), "not readable").otherwise("token list of another shape").alias("reason"))


def in_positions(
    tokens: DataFrame, start: int | None = None, stop: int | None = None,
    types: list[int] | None = None,
) -> DataFrame:
    """Tokens at list places start..stop; ends beyond the list are clamped, start > stop is empty."""
    out = tokens.filter(F.col("pos") >= (start or 0))
    if stop is not None:
        out = out.filter(F.col("pos") <= stop)
    return out.filter(F.col("type").isin(types)) if types else out


def of_type(tokens: DataFrame, type_id: int) -> DataFrame:
    return tokens.filter(F.col("type") == type_id)


def of_type_name(tokens: DataFrame, name: str) -> DataFrame:
    return tokens.filter(F.col("type_name") == name)


def range_text(tokens: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Text of a place range per file, without separators; a part of the file's own text."""
    pieces = F.sort_array(F.collect_list(F.struct("pos", "text")))
    return in_positions(tokens, start, stop).groupBy("file").agg(pieces.alias("p")).select(
        "file", F.array_join(F.col("p.text"), "").alias("text"))


def inside(tokens: DataFrame, start: int, stop: int) -> DataFrame:
    """Tokens wholly inside one character range."""
    return tokens.filter(is_inside(start, stop))


def is_inside(start: int, stop: int) -> Column:
    return (F.col("start_index") >= start) & (F.col("stop_index") <= stop)


def _spans(ranges: DataFrame, bits: int) -> tuple[DataFrame, Column, Column]:
    """Ranges that can hold a token, with their first and last block.

    The block after the range covers an empty token, which stops before it starts.
    """
    first = F.shiftright(F.col("range_start"), bits)
    last = F.shiftright(F.col("range_stop"), bits) + 1
    return ranges.filter("range_stop + 1 >= range_start"), first, last


def _block(bits: int) -> Column:
    return F.shiftright(F.col("start_index"), bits)


def _blocks(ranges: DataFrame, bits: int) -> DataFrame:
    spans, first, last = _spans(ranges, bits)
    return spans.withColumn("_block", F.explode(F.sequence(first, last)))


def _count_blocks(ranges: DataFrame, bits: int) -> int:
    spans, first, last = _spans(ranges, bits)
    return spans.agg(F.sum((last - first + 1).cast("long")).alias("n")).first().n or 0


def _marks(parts: int) -> tuple[Column, list[Column]]:
    """Part of the filter and places in it that a hash `_hash` stands for."""
    places = [F.shiftrightunsigned("_hash", PART_BITS * i).bitwiseAND((1 << PART_BITS) - 1) for i in range(MARKS)]
    return F.shiftrightunsigned("_hash", PART_BITS * MARKS).bitwiseAND(parts - 1), places


def _hashed() -> Column:
    return F.xxhash64("file", F.col("_block").cast("long"))


def mark_near(tokens: DataFrame, ranges: DataFrame, bits: int = RANGE_BITS) -> DataFrame:
    """Adds `_near`: false only for tokens of which no range touches the block.

    The blocks of all ranges become a Bloom filter, of which every task gets a copy, so tokens far from
    all ranges need not be stored or shuffled. Some of one in a hundred of these pass by chance, more
    where the blocks are more than 32 million.
    """
    parts = 1
    while parts < MOST_PARTS and parts << PART_BITS < BITS_A_BLOCK * _count_blocks(ranges, bits):
        parts *= 2
    part, places = _marks(parts)
    # dealt by part before, bit strings are made in one piece
    dealt = _blocks(ranges, bits).select(_hashed().alias("_hash")).withColumn("_part", part).repartition("_part")
    strings = dealt.select("_part", F.explode(F.array(*places)).alias("_place")).groupBy("_part").agg(
        F.bitmap_construct_agg("_place").alias("_bytes"))

    def word(i: Column) -> Column:
        return F.conv(F.hex(F.substring("_bytes", i * 8 + 1, F.lit(8))), 16, -10).cast("long")

    words = strings.select("_part", F.transform(F.sequence(F.lit(0), F.lit((1 << PART_BITS) // 64 - 1)), word).alias("_words"))

    def marked(place: Column) -> Column:
        # the first byte of a word is its highest, the first bit of a byte its lowest
        at = place.bitwiseAND(63).bitwiseXOR(F.lit(56))
        return F.getbit(F.get("_words", F.shiftright(place, 6).cast("int")), at.cast("int")) == 1

    near = F.col("file").isNotNull()
    for place in places:
        near = near & marked(place)
    return (
        tokens.withColumn("_block", _block(bits)).withColumn("_hash", _hashed()).withColumn("_part", part)
        .join(F.broadcast(words), "_part", "left")
        .select(*tokens.columns, F.coalesce(near, F.lit(False)).alias(NEAR))
    )


def inside_ranges(tokens: DataFrame, ranges: DataFrame, bits: int = RANGE_BITS) -> DataFrame:
    """Tokens wholly inside ranges (file, range_start, range_stop), one row per hit.

    Both sides meet on (file, block of the start offset), so a long file is spread over its
    blocks. Only tokens near a range are shuffled; those that `mark_near` has marked with these ranges
    and blocks aren't marked again. The ranges are read several times: pass stored ones.
    """
    marked = tokens if NEAR in tokens.columns else mark_near(tokens, ranges, bits)
    placed = marked.filter(NEAR).drop(NEAR).withColumn("_block", _block(bits))
    blocks = _blocks(ranges, bits)
    few = _count_blocks(ranges, bits) <= BROADCAST_BLOCKS
    return placed.join(F.broadcast(blocks) if few else blocks.hint("merge"), ["file", "_block"]).filter(
        "start_index >= range_start and stop_index <= range_stop").drop("_block")


def between_points(
    tokens: DataFrame, start: tuple[int, int], stop: tuple[int, int]
) -> DataFrame:
    """Tokens between two (line, column) points, both included."""
    point = F.struct("line", "column")

    def at(p: tuple[int, int]) -> Column:
        return F.struct(F.lit(p[0]).alias("line"), F.lit(p[1]).alias("column"))

    return tokens.filter((point >= at(start)) & (point <= at(stop)))


def display(tokens: DataFrame) -> DataFrame:
    """Adds the usual one-line form [@i,a:b='text',<type>,line:col]."""
    # Fixed value: the display form.
    return tokens.withColumn("display", F.format_string(
        "[@%d,%d:%d='%s',<%s>,%d:%d]", "index", "start_index", "stop_index", "text", "type_name",
        "line", "column"))


def type_distribution(tokens: DataFrame) -> DataFrame:
    """Tokens per type name and file."""
    return tokens.groupBy("file", "type_name").agg(F.count("*").alias("tokens"))


def sizes(distribution: DataFrame) -> DataFrame:
    """List length per file, summed up from the distribution."""
    return distribution.groupBy("file").agg(F.sum("tokens").alias("tokens"))


def look_ahead(tokens: DataFrame, offsets: list[int], bits: int = BITS) -> DataFrame:
    """Type (la_n) and text (lt_n) of the token n places on, counted from 1 = this token.

    Outside the list the type is -1 and the text null; 0 and negative offsets look back.
    """
    wanted: dict[int, list[tuple[str, Column]]] = {}
    for n in offsets:
        name = str(n).replace("-", "m")
        wanted.setdefault(n - 1, []).extend([
            (f"la_{name}", F.col("type")), (f"lt_{name}", F.col("text"))])
    seen = look_around(tokens, ["file"], "pos", wanted, bits)
    return seen.withColumns({
        name: F.coalesce(F.col(name), F.lit(END_OF_FILE))
        for columns in wanted.values() for name, _ in columns if name.startswith("la_")
    })
