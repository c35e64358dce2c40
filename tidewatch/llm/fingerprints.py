"""Document fingerprints by a homomorphic multiset hash, in DataFrame functions only.

A text is cut into paragraphs; each is hashed to a wide vector, and the vectors are added
modulo powers of two. The sum doesn't depend on the order of paragraphs, and one paragraph is
put in or taken out by adding or subtracting its vector. The vector has two parts: `EXACT`
lanes of 61-bit hashes, which tell multisets apart, and 128 lanes of single bits, whose sums
estimate how much two multisets share.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

EXACT = 4
LANE_BITS = 61
# A paragraph ends at a line break or a sentence end, a long one also at the first word end
# after this many characters.
PIECE_CHARS = 40
PAIRS = 64  # longs that hold two bit lanes each
_PIECE = rf"(?s)[^\n.!?]{{0,{PIECE_CHARS}}}[^\s.!?]*[\s.!?]*"
_MASK = (1 << LANE_BITS) - 1
_PAIR = 0x0000000100000001
_LOW = 0xFFFFFFFF


def paragraphs(text: Column) -> Column:
    """The pieces of a text, in order; together they are the text. Null and empty have none."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_PIECE), F.lit(0))
    return F.filter(pieces, lambda piece: piece != "")


def vector(pieces: Column) -> Column:
    """The sum of the pieces' vectors: EXACT lanes, PAIRS longs with two lanes each, the count."""
    def exact(seed: int) -> Column:
        return F.aggregate(
            F.transform(pieces, lambda piece: F.xxhash64(F.lit(seed), piece).bitwiseAND(F.lit(_MASK))),
            F.lit(0).cast("long"), lambda total, h: (total + h).bitwiseAND(F.lit(_MASK)))

    def pairs(seed: int) -> Column:
        """32 longs: the low and the high half of the hash give a bit each to every long."""
        bits = F.transform(pieces, lambda piece: F.xxhash64(F.lit(seed), piece))
        return F.transform(
            F.sequence(F.lit(0), F.lit(31)),
            lambda lane: F.aggregate(bits, F.lit(0).cast("long"), lambda total, h: total + F.call_function(
                "shiftright", h, lane).bitwiseAND(F.lit(_PAIR))))

    return F.concat(F.array(*[exact(seed) for seed in range(EXACT)]),
                    *[pairs(-1 - k) for k in range(PAIRS // 32)], F.array(F.size(pieces).cast("long")))


def combined(left: Column, right: Column, sign: int = 1) -> Column:
    """The fingerprint of both multisets together, or of the left one without the right one."""
    def exact(a, b):
        return (a + sign * b).bitwiseAND(F.lit(_MASK))

    return F.zip_with(F.transform(left, lambda value, place: F.struct(value.alias("v"), place.alias("p"))),
                      right, lambda a, b: F.when(a["p"] < EXACT, exact(a["v"], b)).otherwise(a["v"] + sign * b))


def text_of(fingerprint: Column) -> Column:
    """The fingerprint as hexadecimal text, 16 digits per long."""
    return F.array_join(F.transform(fingerprint, lambda v: F.lpad(F.lower(F.hex(v)), 16, "0")), "")


def likeness(left: Column, right: Column) -> Column:
    """An estimate, 0 to 1, of the share of paragraphs that two fingerprints have in common.

    Each bit lane, read as a sum of +1 and -1, is a random walk of the paragraphs, so its square
    estimates a squared length: 1 - |a - b|^2 / (|a|^2 + |b|^2). Equal fingerprints give exactly
    1, also two empty ones.
    """
    first, count = EXACT + 1, EXACT + PAIRS + 1

    def signed(fingerprint: Column, place: Column) -> tuple[Column, Column]:
        pair = F.element_at(fingerprint, place)
        n = F.element_at(fingerprint, F.lit(count))
        low = pair.bitwiseAND(F.lit(_LOW))
        high = F.call_function("shiftright", pair, F.lit(32))
        return (2 * low - n).cast("double"), (2 * high - n).cast("double")

    def squares(place: Column) -> Column:
        a, b = signed(left, place), signed(right, place)
        apart = reduce(lambda x, y: x + y, [(x - y) * (x - y) for x, y in zip(a, b)])
        long = reduce(lambda x, y: x + y, [x * x + y * y for x, y in zip(a, b)])
        return F.struct(apart.alias("apart"), long.alias("long"))

    places = F.sequence(F.lit(first), F.lit(first + PAIRS - 1))
    zero = F.struct(F.lit(0.0).alias("apart"), F.lit(0.0).alias("long"))
    shared = F.aggregate(
        F.transform(places, squares), zero,
        lambda t, v: F.struct((t["apart"] + v["apart"]).alias("apart"), (t["long"] + v["long"]).alias("long")),
        lambda t: 1 - F.try_divide(t["apart"], t["long"]))
    return F.when(left == right, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(shared, F.lit(0.0)))))


def with_next(documents: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, text, lanes (its fingerprint), next_text and next_lanes: those of the following
    document by doc_id; the last one's next is the first.

    Null texts are empty, rows without doc_id come first, equal ids go by text.
    Ids are cut into ranges at approximate quantiles, a bounded list, so no task sees all rows.
    The last document of a range takes the first of the next range that has any: these firsts,
    one per range, are looked up by their ids. doc_id is taken to be a key: rows that repeat one
    id all lie in one range.
    """
    spark = documents.sparkSession
    buckets = buckets or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                             F.coalesce(F.col("text"), F.lit("")).alias("text"))
    cuts = known.select("doc_id").stat.approxQuantile(
        "doc_id", [i / buckets for i in range(1, buckets)], 0.1 / buckets)
    cuts = sorted({int(c) for c in cuts})
    ranges = known.withColumn("bucket", F.coalesce(_position(cuts, 0, len(cuts)), F.lit(-1)))

    # The first document of each range: at most `buckets` + 1 rows.
    ids = ranges.groupBy("bucket").agg(F.min("doc_id").alias("head_id"))
    heads = (ranges.join(F.broadcast(ids.withColumnRenamed("bucket", "range")),
                         (F.col("bucket") == F.col("range")) & F.col("doc_id").eqNullSafe(F.col("head_id")))
             .groupBy("bucket").agg(F.min("text").alias("text")))
    in_turn = Window.partitionBy(F.lit(0)).orderBy("bucket")
    every = in_turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    followers = heads.select(
        F.col("bucket").alias("range"),
        F.coalesce(F.lead("text").over(in_turn), F.first("text").over(every)).alias("head_text"))
    followers = with_lanes(followers, "head_text", "head_lanes")

    inside = Window.partitionBy("bucket").orderBy(F.asc_nulls_first("doc_id"), F.asc("text"))
    marked = with_lanes(ranges, "text", "lanes").select(
        "*", F.lead("text").over(inside).alias("follower"), F.lead("lanes").over(inside).alias("follower_lanes"))
    # The windows' own partitioning serves this join: only `followers` is moved.
    return (marked.join(followers, (F.col("bucket") == F.col("range")) & F.col("follower").isNull(), "left")
            .select("doc_id", "text", "lanes",
                    F.coalesce("follower", "head_text").alias("next_text"),
                    F.coalesce("follower_lanes", "head_lanes").alias("next_lanes")))


def with_lanes(frame: DataFrame, text: str, name: str) -> DataFrame:
    """The frame with the fingerprint of a text column."""
    pieces = f"{name}_pieces"
    return (frame.withColumn(pieces, paragraphs(F.col(text)))
            .withColumn(name, vector(F.col(pieces))).drop(pieces))


def fingerprint_edits(documents: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every document and of an edited form of it, and their likenesses.

    Edited: the last floor(n / 2) of the n characters are replaced by the first as many of the
    next document. An empty table gives no rows; repeated rows are each other's next.
    """
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), n - half), F.left(F.col("next_text"), half))
    rows = with_next(documents, buckets).withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    rows = with_lanes(rows, "edited", "edited_lanes")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        text_of(F.col("lanes")).alias("fingerprint"), text_of(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"))


def _position(cuts: list[int], low: int, high: int) -> Column:
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(F.col("doc_id") < cuts[middle], _position(cuts, low, middle)).when(
        F.col("doc_id") >= cuts[middle], _position(cuts, middle + 1, high))
