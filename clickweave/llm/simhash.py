"""SimHash fingerprints of 128 bits, and search by permuted block tables.

Terms are pairs of neighbouring words (the last word stands alone), weighted by
the length of the first, up to 15. Each term's hash votes with its weight for or against
every bit; the sign of the sum is the fingerprint's bit. Four bits share one
64-bit sum over a segment of 2048 terms, so a term's votes are 32 plain SQL sums;
segments are added up with two bits to a sum.

``within`` finds all fingerprints inside a Hamming radius of 3: fingerprints are
cut into four blocks of 32 bits; two that differ in at most 3 bits agree in a
whole block, so one table per block, keyed by (block, value), is joined by
equality and the distance checked. Values that many fingerprints share (a group
of near copies) are keyed by 32 bits more: of the other six half blocks at least
three agree, so two of the first three or two of the last three do, which makes
six permuted tables of 64 agreeing bits. It works on distinct fingerprints:
copies cost nothing.

``followed`` gives each row the row that follows in doc_id order without one
global sort: quantiles of doc_id cut the table into ranges of about ``RANGE``
rows, ``lead`` runs inside a range, and a range's last row takes the first row
of the next range (one window over the range numbers alone says which). Texts are
shuffled once; the sums are taken where the texts lie.

DataFrame and SQL functions only.

Edge cases: a null text counts as empty; without words all bits are 0; null
doc_id comes first, ordered by text hash and cut by it; rows of one doc_id are
ordered by text hash; a very long text is one row, its terms are summed as they
are split off; the only row of a table follows itself; an empty table
gives no rows. Columns of the input other than doc_id and text are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import maybe_broadcast, stored

BITS = 128
RADIUS = 3
#: Rows of a doc_id range; most ranges.
RANGE, MOST = 2000, 100_000
_NULL_CUTS = 10  # bits of the text hash that cut the rows without doc_id


def terms(text: Column) -> Column:
    """array<long>: a value per term, its weight in the lowest four bits."""
    found = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    after = F.slice(found, 2, F.greatest(F.size(found), F.lit(1)))
    return F.zip_with(found, after, lambda a, b: F.xxhash64(a, b).bitwiseAND(F.lit(-16)).bitwiseOR(
        F.least(F.length(a), F.lit(15)).cast("long")))


#: Terms whose votes are summed together: four sums of 16 bits share a signed long,
#: so the uppermost has 15 bits, and a term weighs 15 at most: (2**15 - 1) // 15 = 2184
#: terms never overflow, whatever they vote.
SEGMENT = 2048


def segment_votes() -> list[Column]:
    """32 sums of four bits' votes each over columns h and g (hashes) and w
    (weight) of at most SEGMENT terms, and the total."""
    out = []
    for part, h in enumerate("hg"):
        out += [F.expr(f"sum(w * (shiftright({h}, {i}) & 281479271743489L))").alias(f"q{part}_{i}") for i in range(16)]
    return [*out, F.sum("w").alias("weight")]


def votes() -> list[Column]:
    """64 sums of two bits' votes each, from the segments' sums, and the total. A
    term weighs no more than its bytes, so a text (under 2**31 bytes) never overflows."""
    out = []
    for part in range(2):
        for i in range(32):
            q, at = f"q{part}_{i % 16}", i // 16 * 16
            out.append(F.expr(f"sum((shiftrightunsigned({q}, {at}) & 65535L) + shiftleft(shiftrightunsigned({q}, {at + 32}) & 65535L, 32))").alias(f"v{part}_{i}"))
    return [*out, F.sum("weight").alias("total")]


def bits(part: int) -> Column:
    """The 64 bits of one half from its packed sums."""
    out = None
    for i in range(32):
        for half, shift in (("& 4294967295L", i), ("", i + 32)):
            s = f"(v{part}_{i} {half})" if half else f"shiftrightunsigned(v{part}_{i}, 32)"
            bit = F.expr(f"if(2 * {s} > total, shiftleft(1L, {shift}), 0L)")
            out = bit if out is None else out.bitwiseOR(bit)
    return out


def text_form(*longs: str) -> Column:
    """Longs as 16 hex digits each."""
    return F.concat(*[F.lpad(F.lower(F.hex(c)), 16, "0") for c in longs])


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """1 less the share of bits that differ."""
    apart = [F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b)]
    return 1.0 - (apart[0] + apart[1]) / F.lit(float(BITS))


def ranges(docs: DataFrame) -> Column:
    """Number of the doc_id range of a row; ascending with (doc_id, hash)."""
    n = docs.count()
    k = max(1, min(MOST, n // RANGE))
    edges = [] if k < 2 else docs.agg(F.percentile_approx("doc_id", [i / k for i in range(1, k)], 50 * k)).first()[0] or []
    edges = sorted(set(edges))
    null = F.shiftrightunsigned(F.col("th").bitwiseXOR(F.lit(-2**63)), 64 - _NULL_CUTS) - (1 << _NULL_CUTS)
    if not edges:
        return F.when(F.col("doc_id").isNull(), null).otherwise(F.lit(0).cast("long"))
    table = F.split(F.lit(",".join(map(str, edges))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in range(len(edges).bit_length() - 1, -1, -1)])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(edges)) & (F.coalesce(F.get(table, at + step - 1), F.lit(0)) <= F.col("doc_id")), at + step).otherwise(at))
    return F.when(F.col("doc_id").isNull(), null).otherwise(found.cast("long"))


def followed(rows: DataFrame, order: list[str], values: list[str], name: str) -> DataFrame:
    """Adds next_<value> of the row that follows in (part, order); the last row
    is followed by the first. Rows must carry ``part``."""
    firsts = stored(rows.groupBy("part").agg(*[F.min_by(F.struct(v), F.struct(*order)).alias(v) for v in values]), name)
    line = W.orderBy("part")
    whole = line.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    after = firsts.select(F.col("part").alias("_p"), F.coalesce(F.lead("part").over(line), F.first("part").over(whole)).alias("_after"))
    firsts = stored(after.join(firsts, F.col("_after") == F.col("part")).select("_p", *[F.col(v)[v].alias(f"first_{v}") for v in values]), name)
    size = sum((F.coalesce(F.octet_length(F.col(f"first_{v}").cast("string")), F.lit(0)) for v in values), F.lit(16))
    inside = W.partitionBy("part").orderBy(*order)
    led = rows.select("*", F.row_number().over(inside).alias("place"),
                      *[F.lead(F.struct(v)).over(inside).alias(f"lead_{v}") for v in values])
    led = led.join(maybe_broadcast(firsts, size), led["part"] == F.col("_p"))
    return led.select(*[F.col(c) for c in rows.columns], "place", *[
        F.when(F.col(f"lead_{v}").isNotNull(), F.col(f"lead_{v}")[v]).otherwise(F.col(f"first_{v}")).alias(f"next_{v}") for v in values])


#: Fingerprints of one block value beyond which it is keyed by more bits.
MANY = 64
#: Pairs of the six half blocks outside a block, two of the first or last three.
_PAIRS = [(0, 1), (0, 2), (1, 2), (3, 4), (3, 5), (4, 5)]


def _bits_at(start: int, width: int) -> Column:
    """``width`` bits of (hi, lo) from bit ``start`` on, inside one half."""
    half, at = ("hi", start) if start < 64 else ("lo", start - 64)
    return F.shiftrightunsigned(half, at).bitwiseAND(F.lit((1 << width) - 1))


def _blocks() -> Column:
    return F.array(*[F.struct(F.lit(i).alias("block"), _bits_at(32 * i, 32).alias("value")) for i in range(BITS // 32)])


def _more_bits() -> Column:
    """array<struct<pair, rest>>: the six 32-bit keys outside the row's block."""
    out = None
    for block in range(BITS // 32):
        halves = [_bits_at(16 * k, 16) for k in range(BITS // 16) if k // 2 != block]
        keys = F.array(*[F.struct(F.lit(i).alias("pair"), F.shiftleft(halves[x], 16).bitwiseOR(halves[y]).alias("rest"))
                         for i, (x, y) in enumerate(_PAIRS)])
        out = keys if out is None else F.when(F.col("block") == block, keys).otherwise(out)
    return out


def within(asked: DataFrame, table: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (q_hi, q_lo, hi, lo) of asked and table fingerprints (columns hi,
    lo; distinct rows) at most ``radius`` (up to 3) bits apart."""
    if not 0 <= radius <= 3:
        raise ValueError("the block tables find fingerprints up to 3 bits apart")
    a, b = (x.select("hi", "lo").distinct().select("hi", "lo", F.inline(_blocks())) for x in (asked, table))
    full = b.groupBy("block", "value").agg(F.count("*").alias("m")).where(F.col("m") > MANY).select("block", "value")
    full = stored(full, "simhash-full")
    side = maybe_broadcast(full.withColumn("full", F.lit(True)), 16)

    def keyed(x: DataFrame) -> DataFrame:
        some = x.join(side, ["block", "value"], "left")
        keys = F.when(F.col("full"), _more_bits()).otherwise(F.array(F.struct(F.lit(-1).alias("pair"), F.lit(0).cast("long").alias("rest"))))
        return some.select("hi", "lo", "block", "value", F.inline(keys))
    a = keyed(a).withColumnsRenamed({"hi": "q_hi", "lo": "q_lo"})
    near = F.bit_count(F.col("hi").bitwiseXOR(F.col("q_hi"))) + F.bit_count(F.col("lo").bitwiseXOR(F.col("q_lo"))) <= radius
    return a.join(keyed(b), ["block", "value", "pair", "rest"]).where(near).select("q_hi", "q_lo", "hi", "lo").distinct()


def fingerprints(rows: DataFrame, text: list[str], keys: list[str], keep: list[str]) -> DataFrame:
    """(keys, keep, hi_<t>, lo_<t> for each text column t): one pass over the
    terms of all text columns. ``keys`` name a row; rows of one key lie in one
    partition or are shuffled as sums. ``keep``: columns of numbers. All buffers
    are numbers, so the sums are hash aggregations."""
    each = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(t).alias("t")) for i, t in enumerate(text)])
    long = (rows.select(*keys, *keep, F.inline(each)).select(*keys, *keep, "kind", F.posexplode_outer(terms(F.col("t"))).alias("at", "x"))
            .select(*keys, *keep, "kind", F.coalesce(F.floor(F.col("at") / SEGMENT), F.lit(0)).alias("segment"),
                    F.xxhash64("x").alias("h"), F.xxhash64("x", F.lit(1)).alias("g"),
                    F.coalesce(F.col("x").bitwiseAND(F.lit(15)), F.lit(0)).cast("long").alias("w")))
    segments = long.groupBy(*keys, "kind", "segment").agg(*segment_votes(), *[F.max(c).alias(c) for c in keep])
    summed = segments.groupBy(*keys, "kind").agg(*votes(), *[F.max(c).alias(c) for c in keep])
    made = summed.select(*keys, *keep, "kind", bits(0).alias("hi"), bits(1).alias("lo"))
    return made.groupBy(*keys).agg(*[F.max(c).alias(c) for c in keep], *[
        F.max(F.when(F.col("kind") == i, F.col(h))).alias(f"{h}_{t}") for i, t in enumerate(text) for h in ("hi", "lo")])


def numbers_of(digest: Column) -> list[Column]:
    """A digest of 64 hex digits as four longs."""
    return [F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("long") for i in range(4)]


def edited_likeness(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, edited_hits (distinct
    fingerprints of the table within ``radius`` of the edited one)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    rows = rows.withColumn("part", ranges(rows))
    order = ["doc_id", "th"]
    led = followed(rows, order, ["text"], "simhash-firsts")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    led = (led.withColumn("edited", edited).withColumn("n_chars", n.cast("long"))
           .withColumn("sha", F.sha2(F.encode("edited", "utf-8"), 256)))
    sha = [f"sha_{i}" for i in range(4)]
    led = led.select("part", "place", "doc_id", "n_chars", "text", "edited", *[c.alias(x) for c, x in zip(numbers_of(F.col("sha")), sha)])
    made = stored(fingerprints(led, ["text", "edited"], ["part", "place"], ["doc_id", "n_chars", *sha]), "simhash")
    near = followed(made.withColumnRenamed("place", "at"), ["at"], ["hi_text", "lo_text"], "simhash-next")
    hits = (within(made.select(F.col("hi_edited").alias("hi"), F.col("lo_edited").alias("lo")),
                   made.select(F.col("hi_text").alias("hi"), F.col("lo_text").alias("lo")), radius)
            .groupBy(F.col("q_hi").alias("hi_edited"), F.col("q_lo").alias("lo_edited")).agg(F.count("*").alias("hits")))
    own, changed, after = ("hi_text", "lo_text"), ("hi_edited", "lo_edited"), ("next_hi_text", "next_lo_text")
    return near.join(hits, ["hi_edited", "lo_edited"], "left").select(
        "doc_id", "n_chars", text_form(*sha).alias("edited_sha256"), text_form(*own).alias("fingerprint"), text_form(*changed).alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"), likeness(own, after).alias("near_next"),
        F.coalesce("hits", F.lit(0)).cast("long").alias("edited_hits"))
