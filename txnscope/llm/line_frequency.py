"""Quality rules by cross-document line frequency (DataFrame functions only).

Every line is normalised (A-Z lower-cased, digits 1-9 as 0, white space at the
ends cut) and hashed.  For each host the number of documents holding a line is
counted, each row being a document of its own, copies too.  A line found in
more than ``min_docs`` of them is boilerplate and is removed, however large the
host is.  A document is depleted, and rejected, when boilerplate was removed
and fewer than ``min_words`` words or less than ``min_left`` of its words stay.

Counts are added up before the shuffle, so only one (host, line hash, count)
row a task and line is moved, never texts, as long as the list of frequent
lines is small.  All keys contain a hash, so a hot host is spread over all
tasks.  A row looks a line up in one of its host's buckets of about 8 hashes,
whatever the length of the list.

Edge cases: null text is empty (base rules fail); null host is a host of its
own; equal rows are documents of their own and get equal verdicts; an empty
table gives an empty result; a caller's column that has the name of a computed
one is replaced by it, all others stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.llm.common import SPACES, fresh, text_of, words_of
from txnscope.session import materialize

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def repeated_words(words: Column) -> Column:
    """Words lying in an eight-word window that is found twice or more in ``words``.

    Windows are hashed; only texts with an equal pair are sorted by (hash,
    position), so the usual text costs one pass."""
    n = F.size(words)
    hashes = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW)))
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        flagged = F.transform(F.array(pairs), lambda s: F.filter(
            s, lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))))[0]
        at = F.sort_array(F.transform(flagged, lambda x: x["i"]))
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(at, start, lambda a, x: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).cast("bigint").alias("n"), x.alias("last")))["n"]

    # transform() over a one-element array names the hashes once, so that they are computed once.
    return F.transform(F.array(hashes), lambda hs: F.when(
        F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("bigint")).otherwise(covered(hs)))[0]


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five counts and ``base_failed``."""
    own = fresh(docs, "_own")
    t = text_of(text)
    lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    out = docs.withColumn(own, F.struct(t.alias("t"), words_of(t).alias("words"), lines.alias("lines")))
    t, words, lines = (F.col(own)[c] for c in ("t", "words", "lines"))
    out = out.withColumns({
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("bigint"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        "n_repeat_words": repeated_words(words),
    }).drop(own)
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def normal_lines(t: Column) -> Column:
    """Normalised lines of a text, in order, empty ones included."""
    norm = F.translate(t, UPPER + "123456789\t\x0b\x0c\r", UPPER.lower() + "0" * 9 + "    ")
    return F.transform(F.split(norm, "\n"), lambda x: F.trim(x))


def _host(col: str) -> Column:
    # Null is a host of its own, apart from the empty string.
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("null"))


def frequent_lines(docs: DataFrame, text: str, host: str, min_docs: int) -> DataFrame:
    """(host, line_hash) of the lines in more than ``min_docs`` documents of their host."""
    lines = docs.select(_host(host).alias("host"), F.explode(F.array_distinct(F.transform(
        F.filter(normal_lines(text_of(text)), lambda x: x != ""), lambda x: F.xxhash64(x)))).alias("line_hash"))
    return lines.groupBy("host", "line_hash").agg(F.count("*").alias("n")).where(F.col("n") > min_docs) \
        .select("host", "line_hash")


def bucketed(found: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row for each value of ``keys``, with its hashes as an array ``name`` of n // 8 + 1 buckets by remainder."""
    sizes = found.groupBy(*keys).agg((F.floor(F.count("*") / 8) + 1).cast("int").alias("n"))
    own = found.join(sizes, keys).select(*keys, F.pmod("line_hash", F.col("n")).cast("int").alias("bucket"), "line_hash")
    all_buckets = sizes.select(*keys, F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("bucket"),
                               F.lit(None).cast("bigint").alias("line_hash"))
    buckets = own.unionByName(all_buckets).groupBy(*keys, "bucket").agg(F.collect_list("line_hash").alias("hashes"))
    return buckets.groupBy(*keys).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("bucket", "hashes"))), lambda x: x["hashes"]).alias(name))


def _with_frequent(docs: DataFrame, text: str, host: str, found: DataFrame, broadcast_rows: int, name: str) -> DataFrame:
    """``docs`` with ``name``: buckets of the frequent lines that matter for the row, null if there are none.

    A list of up to ``broadcast_rows`` lines is sent to all tasks.  Beyond, rows meet their lines by (host, text hash)."""
    h, x = fresh(docs, "_host_key"), fresh(docs, "_text_key")
    keyed = docs.withColumn(h, _host(host))
    if found.count() <= broadcast_rows:
        return keyed.join(F.broadcast(bucketed(found, ["host"], name).withColumnRenamed("host", h)), h, "left").drop(h)
    t = text_of(text)
    mine = docs.select(_host(host).alias("host"), F.xxhash64(t).alias("text_hash"), F.explode(F.array_distinct(
        F.transform(normal_lines(t), lambda x: F.xxhash64(x)))).alias("line_hash")).distinct() \
        .join(found, ["host", "line_hash"], "left_semi")
    lists = bucketed(mine, ["host", "text_hash"], name).withColumnsRenamed({"host": h, "text_hash": x})
    return keyed.withColumn(x, F.xxhash64(t)).join(lists, [h, x], "left").drop(h, x)


def filter_lines(docs: DataFrame, text: str = "text", host: str = "source", min_docs: int = 10,
                 min_left: float = 0.3, broadcast_rows: int = 100_000) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``clean_text`` (frequent lines removed),
    ``n_removed_lines``, ``words_left`` and ``kept``."""
    t = text_of(text)
    found = materialize(frequent_lines(docs, text, host, min_docs), "frequent-lines")
    out = base_counts(docs, text)
    f, k = fresh(out, "_frequent"), fresh(out, "_kept_lines")
    out = _with_frequent(out, text, host, found, broadcast_rows, f)
    raw = F.split(t, "\n")
    pairs = F.arrays_zip(raw.alias("raw"), F.transform(normal_lines(t), lambda x: F.xxhash64(x)).alias("hash"))
    kept = F.transform(F.filter(pairs, lambda z: ~F.array_contains(
        F.get(F.col(f), F.pmod(z["hash"], F.size(f)).cast("int")), z["hash"])), lambda z: z["raw"])
    out = out.withColumn(k, F.when(F.col(f).isNotNull(), kept))
    out = out.withColumn("n_removed_lines", F.coalesce(F.size(raw) - F.size(k), F.lit(0)).cast("bigint"))
    touched = F.col("n_removed_lines") > 0
    out = out.withColumn("clean_text", F.when(touched, F.array_join(k, "\n")).otherwise(t)).drop(k, f)
    out = out.withColumn("words_left", F.when(touched, F.size(words_of(F.col("clean_text"))).cast("bigint"))
                         .otherwise(F.col("n_words")))
    depleted = touched & ((F.col("words_left") < MIN_WORDS) | (F.col("words_left") < min_left * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def filter_sql(min_docs: int = 10, min_left: float = 0.3) -> str:
    """The counts and verdicts of ``filter_lines`` over the table ``documents`` in DuckDB, comparing lines instead of hashes."""
    word = r"[^\x20\x09-\x0D]+"
    chars = "'" + UPPER + "123456789' || chr(9) || chr(11) || chr(12) || chr(13)"
    plain = "'" + UPPER.lower() + "0" * 9 + "    '"
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
          regexp_extract_all(coalesce(text, ''), '{word}') AS ws FROM documents),
        starts AS (SELECT d.rid, ws, i FROM d JOIN (SELECT rid, unnest(range(1, greatest(len(ws) - {WINDOW - 2}, 1))) AS i FROM d) s
          ON d.rid = s.rid),
        windows AS (SELECT rid, unnest(list(i)) AS i FROM starts GROUP BY rid, array_to_string(ws[i:i + {WINDOW - 1}], ' ')
          HAVING count(*) > 1),
        covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS p FROM windows)
          GROUP BY rid),
        lines AS MATERIALIZED (SELECT rid, source, t, line, pos, trim(translate(line, {chars}, {plain}), ' ') AS norm FROM (
          SELECT rid, source, t, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d)),
        worded AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{word}') GROUP BY rid),
        frequent AS (SELECT source, norm FROM (SELECT DISTINCT rid, source, norm FROM lines WHERE norm <> '') GROUP BY source, norm
          HAVING count(*) > {min_docs}),
        marked AS (SELECT l.*, f.norm IS NOT NULL AS gone FROM lines l LEFT JOIN frequent f
          ON l.source IS NOT DISTINCT FROM f.source AND l.norm = f.norm),
        cleaned AS (SELECT rid, count(*) FILTER (WHERE gone) AS removed,
          coalesce(sum(len(regexp_extract_all(line, '{word}'))) FILTER (WHERE NOT gone), 0) AS words FROM marked GROUP BY rid),
        counted AS (SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
          length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols, coalesce(w.n, 0) AS n_dup_lines,
          coalesce(c.n, 0) AS n_repeat_words, x.removed AS n_removed_lines, x.words::BIGINT AS words_left
          FROM d LEFT JOIN covered c USING (rid) LEFT JOIN worded w USING (rid) JOIN cleaned x USING (rid)),
        base AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
        SELECT *, NOT base_failed AND NOT (n_removed_lines > 0 AND (words_left < {MIN_WORDS} OR words_left < {min_left} * n_words)) AS kept
        FROM base"""
