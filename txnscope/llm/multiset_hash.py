"""Document fingerprints by a homomorphic multiset hash (DataFrame functions only).

A text is the multiset of its paragraphs: pieces that end after a line break,
or after ``.``, ``!`` or ``?`` and a space, separators included, so the pieces
joined give the text back.  Each piece is hashed to a wide vector; the
fingerprint is the sum of the vectors, lane by lane, modulo powers of two:

* two lanes modulo 2^62 with the 62 low bits of two independent 64-bit hashes,
* 124 lanes modulo 2^30, two packed in a long, that count one bit each of the
  same two hashes,
* one lane modulo 2^30 with the number of pieces.

The sum does not depend on the order, and ``insert`` / ``delete`` add or take
away the vector of a piece or of a whole other multiset.  A lane of 30 bits
cannot run over: an array of hashes ends at 2^28 pieces in Spark.

The bit lanes are a tug-of-war sketch: with ``c`` ones among ``n`` pieces a
lane stands for ``2c - n``, and the mean of the product of two fingerprints'
lanes estimates ``A . B``, the sum over pieces of the product of their two
multiplicities.  ``likeness`` is ``2 A.B / (A.A + B.B)`` from those estimates:
the Dice coefficient of the two count vectors, which for texts without
repeated pieces is twice the common pieces over all pieces of both, and which
weighs a repeated piece by its multiplicity in both.  It is 1 for equal
fingerprints; its standard error is at most ``sqrt(2 / 124)`` = 0.127 of the
part that differs, at any number of pieces.

Edge cases: null text is empty, the empty text has the zero vector; a table of
one row is its own next document; ties in ``doc_id`` are ordered by text hash,
text; rows without ``doc_id`` come last in descending order; extra columns are
left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnscope.llm.common import text_of
from txnscope.session import materialize

PIECE_END = r"(?<=\n)|(?<=[.!?] )"
LANE = 1 << 30
LANES_MASK = (LANE - 1) | (LANE - 1) << 31
ONES = 1 | 1 << 31
WIDE_MASK = (1 << 62) - 1
SHIFTS = 31
N_SKETCH = 2 * SHIFTS                          # longs holding the 124 bit lanes
MIN_ID = -(1 << 63)


def _fold(hashes: Column, term, mask: int) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("bigint"),
                       lambda a, h: (a + term(h)).bitwiseAND(F.lit(mask)))


def fingerprint(text: Column) -> Column:
    """array<bigint>: 62 packed sketch longs, two wide lanes, the piece count."""
    pieces = F.filter(F.split(text, PIECE_END), lambda p: p != "")
    first = F.transform(pieces, lambda p: F.xxhash64(p))

    def lanes(h1: Column, h2: Column) -> Column:
        out = []
        for hashes in (h1, h2):
            for s in range(SHIFTS):
                out.append(_fold(hashes, lambda h, s=s: F.shiftrightunsigned(h, s).bitwiseAND(F.lit(ONES)),
                                 LANES_MASK))
        for hashes in (h1, h2):
            out.append(_fold(hashes, lambda h: h.bitwiseAND(F.lit(WIDE_MASK)), WIDE_MASK))
        out.append(F.size(h1).cast("bigint"))
        return F.array(*out)

    both = F.transform(F.array(first), lambda h: F.struct(
        h.alias("a"), F.transform(h, lambda x: F.xxhash64(x, F.lit("second"))).alias("b")))
    return F.transform(both, lambda p: lanes(p["a"], p["b"]))[0]


def _modulo(x: Column, i: Column) -> Column:
    # Taking away first adds the modulus to every lane, so no lane borrows from its neighbour.
    return F.when(i < N_SKETCH, x.bitwiseAND(F.lit(LANES_MASK))).when(
        i < N_SKETCH + 2, x.bitwiseAND(F.lit(WIDE_MASK))).otherwise(x.bitwiseAND(F.lit(LANE - 1)))


def insert(fp: Column, other: Column) -> Column:
    """Fingerprint of the union (multiplicities add)."""
    return F.transform(F.zip_with(fp, other, lambda a, b: a + b), _modulo)


def delete(fp: Column, other: Column) -> Column:
    """Fingerprint with the pieces of ``other`` taken away."""
    guard = LANE * ONES                           # one modulus in each packed lane
    pair = F.zip_with(fp, other, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.transform(pair, lambda p, i: F.when(
        i < N_SKETCH, (p["a"].bitwiseOR(F.lit(guard)) - p["b"]).bitwiseAND(F.lit(LANES_MASK)))
        .when(i < N_SKETCH + 2, (p["a"] - p["b"]).bitwiseAND(F.lit(WIDE_MASK)))
        .otherwise((p["a"] - p["b"]).bitwiseAND(F.lit(LANE - 1))))


def _centred(fp: Column) -> Column:
    """The 124 lanes as 2c - n, differences of fingerprints read as signed."""
    signed = lambda x: F.when(x >= LANE // 2, x - LANE).otherwise(x)
    return F.transform(F.array(fp), lambda v: F.flatten(F.transform(F.slice(v, 1, N_SKETCH), lambda x: F.array(*[
        2 * signed(F.shiftrightunsigned(x, 31 * k).bitwiseAND(F.lit(LANE - 1))) - signed(v[N_SKETCH + 2])
        for k in range(2)]))))[0]


def _energy(fp: Column) -> Column:
    return F.aggregate(_centred(fp), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1; 1 for equal fingerprints (two empty texts included)."""
    apart = _energy(delete(a, b))                # A.A + B.B - 2 A.B, so one minus its share is the coefficient
    both = _energy(a) + _energy(b)
    return F.when(a == b, F.lit(1.0)).when(both == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.lit(1.0) - apart / both))


def as_text(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.hex(x)), "-")


def _at_or_below(cuts: Column, k: Column, strictly: bool = False) -> Column:
    """Number of sorted ``cuts`` at or below ``k`` (strictly below it), by halving."""
    def step(a, _):
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        low = F.get(cuts, mid) < k if strictly else F.get(cuts, mid) <= k
        go = a["lo"] < a["hi"]
        return F.struct(F.when(go & low, mid + 1).otherwise(a["lo"]).alias("lo"),
                        F.when(go & ~low, mid).otherwise(a["hi"]).alias("hi"))
    steps = F.ceil(F.log2(F.size(cuts) + F.lit(1.0))).cast("int") + 1
    start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), steps), start, step)["lo"]


def _quantiles(n: int) -> list[float]:
    return [i / n for i in range(1, n)]


def _cuts(keys: DataFrame, n_parts: int, unit: int, coarse: int = 1000) -> list[int]:
    """At most about ``n_parts`` sorted ids that cut the bytes evenly, a heavy id as often as it fills a part.

    A row counts as one point for each ``unit`` bytes, the rest by a hash.  Beyond ``coarse`` parts each coarse range
    is cut again, so the driver receives the cuts only."""
    rest = F.pmod(F.xxhash64("k", "tie", F.lit("rest")), F.lit(unit)) < F.col("size") % unit
    points = keys.withColumn("points", F.floor(F.col("size") / unit).cast("int") + rest.cast("int")) \
        .where("points > 0").select("k", F.explode(F.sequence(F.lit(1), F.col("points"))))
    first = min(n_parts, coarse)
    found = points.select(F.percentile_approx("k", _quantiles(first) or [0.5], 100 * first)).first()[0] or []
    if n_parts <= coarse or not found:
        return sorted(found) if n_parts > 1 else []
    fine = -(-n_parts // coarse)
    wide = points.join(F.broadcast(_one_row(keys, found)), how="cross")
    more = wide.groupBy(_at_or_below(F.col("cuts"), F.col("k")).alias("range")) \
        .agg(F.percentile_approx("k", _quantiles(fine), 100 * fine).alias("fine")).collect()
    heavy = [c for c, after in zip(found, found[1:]) if c == after for _ in range(fine - 1)]
    return sorted([*found, *heavy, *(c for r in more for c in r["fine"])])


def _one_row(df: DataFrame, cuts: list[int]) -> DataFrame:
    return df.sparkSession.createDataFrame([(sorted(cuts),)], "cuts array<bigint>")


def with_next(docs: DataFrame, part_bytes: int = 32 << 20) -> DataFrame:
    """(doc_id, text, vec, next_text, next_vec): each row with its successor in descending ``doc_id``.

    Rows are cut into ranges of about ``part_bytes``, as many as their bytes ask for, by id and, where one id (or
    null) fills several ranges, by text hash; only rows equal in id and text, and a single long text, stay together.
    A window works inside each range.  The head of the range below joins each range as a sentinel, so the last row of
    a range finds its successor without a global sort.  The driver holds one number for each range."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(MIN_ID))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("k"), text_of().alias("text")) \
        .withColumn("tie", F.xxhash64("text"))
    # A row of an empty text takes room too: its vectors.
    keys = materialize(rows.select("k", "tie", (F.octet_length("text").cast("bigint") + 512).alias("size")), "text-keys")
    size = keys.select(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    cuts = _cuts(keys, size // part_bytes + 1, max(1, part_bytes // 64))
    spark = docs.sparkSession

    def parted(df: DataFrame) -> DataFrame:
        if not cuts:
            return df.withColumn("part", F.lit(0))
        high, low = (_at_or_below(F.col("cuts"), F.col("k"), strictly) for strictly in (False, True))
        df = df.join(F.broadcast(_one_row(df, cuts)), how="cross").withColumns({"high": high, "low": low})
        # Ranges above ``low`` up to ``high`` hold this id only: small hashes in the highest, as they come first.
        share = F.col("tie") / F.lit(2.0 ** 64) + F.lit(0.5)
        sub = F.least(F.floor(share * (F.col("high") - F.col("low"))).cast("int"), F.col("high") - F.col("low") - 1)
        return df.withColumn("part", F.when(F.col("high") > F.col("low"), F.col("high") - sub)
                             .otherwise(F.col("high"))).drop("cuts", "high", "low")

    first = parted(keys).groupBy("part").agg(F.max(F.struct("k", F.bitwise_not("tie").alias("turned"))).alias("head"))
    heads = {r["part"]: (r["head"]["k"], ~r["head"]["turned"]) for r in first.collect()}
    order = sorted(heads)                                   # lowest range first; the lowest is followed by the highest
    to_part = spark.createDataFrame([(*heads[order[i - 1]], p) for i, p in enumerate(order)],
                                    "k bigint, tie bigint, part int")
    sentinels = rows.drop("doc_id").join(F.broadcast(to_part), ["k", "tie"]).groupBy("part", "k", "tie") \
        .agg(F.min("text").alias("text")).withColumns({"doc_id": F.lit(None).cast("bigint"), "sentinel": F.lit(1)})
    both = parted(rows).withColumn("sentinel", F.lit(0)).unionByName(sentinels) \
        .withColumn("vec", fingerprint(F.col("text")))
    # The single range of a small table holds its own head twice: as row and as sentinel.
    w = Window.partitionBy("part").orderBy(F.col("sentinel"), F.col("k").desc(), "tie", "text")
    return both.withColumns({"next_text": F.lead("text").over(w), "next_vec": F.lead("vec").over(w)}) \
        .where("sentinel = 0").select("doc_id", "text", "vec", "next_text", "next_vec")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    d = with_next(docs)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    d = d.withColumn("n_chars", n.cast("bigint")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    d = d.withColumn("edited_vec", fingerprint(F.col("edited")))
    return d.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                    as_text(F.col("vec")).alias("fingerprint"), as_text(F.col("edited_vec")).alias("edited_fingerprint"),
                    likeness(F.col("vec"), F.col("edited_vec")).alias("near_edited"),
                    likeness(F.col("vec"), F.col("next_vec")).alias("near_next"))
