"""Operators against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""
import base64
import collections
import hashlib
import heapq
import math
import re
import zlib

import numpy as np
import pytest
import xxhash

from txnscope.llm import (backoff_lm, components, html_tokens, line_frequency, mixing, multiset_hash, packing, simhash,
                          toxicity, url_reputation, warc, wrappers)
from txnscope.llm.queries import RULES, tokenizer_path
from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, n):
    r = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(r.integers(0, len(WORDS), n), r.integers(0, 9, n)))


LONG = prose(99, 6000)
TEXTS = [
    (1, prose(1, 60), "a"), (2, prose(1, 60), "a"), (3, prose(1, 59) + " changed", "b"), (4, None, None), (5, "", "b"),
    (6, " \t\n", "a"), (7, LONG, "c"), (8, LONG + " end", "c"), (9, "One two.\nThree four! Five?\nOne two.", ""),
    (9, "One two.\nThree four! Five?\nOne two.", ""), (10, "Straße \U0001F600 café x\x0by", "b"),
    (None, "no id here", "a"), (12, "a b c d e f g h i a b c d e f g h j", None), (13, "<|endoftext|>  two", "a")]
SCHEMA = "doc_id bigint, text string, source string, fingerprint int, kept int, block int, size int, host int, n bigint"


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns carry names that the operators use themselves."""
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


# --- 1 WARC
def test_warc_records_link_and_keep_digests(spark):
    html = "<html><head><title>T &amp; t</title></head><body><p>One<br>two</p><a href='/x'>three</a><script>no</script></body></html>"
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-A: b\r\n c\r\n\r\n" + html
    rows = [("<urn:uuid:1>", "http://h/", "2024-01-01T00:00:00Z", http, None, "sha1:STATED", 1),
            (None, None, None, None, None, None, 2),
            ("<urn:uuid:3>", "http://h/i", None, "HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\nxx", None, None, 3)]
    df = spark.createDataFrame(rows, "record_id string, target_uri string, date string, http string, block_digest string, "
                                     "payload_digest string, k int")
    out = warc.derivatives(df, key="k").withColumn("raw", warc.serialised())
    got = {(r["k"], r["record_type"]): r for r in out.collect()}
    assert set(got) == {(1, "metadata"), (1, "conversion"), (2, "metadata"), (2, "conversion"), (3, "metadata")}
    conv, meta = got[1, "conversion"], got[1, "metadata"]
    assert conv["block"] == "T & t\nOne two\nthree" and conv["refers_to"] == meta["refers_to"] == "<urn:uuid:1>"
    h = {x["name"]: x["value"] for x in conv["headers"]}
    assert h["WARC-Refers-To"] == "<urn:uuid:1>" and h["WARC-Source-Payload-Digest"] == "sha1:STATED"
    assert h["WARC-Concurrent-To"] == meta["record_id"]
    assert h["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(conv["block"].encode()).digest()).decode()
    assert "http-header: X-A: b c" in meta["block"] and "outlink: a@href /x" in meta["block"]
    head, _, rest = conv["raw"].partition("\r\n\r\n")
    assert rest == conv["block"] + "\r\n\r\n" and int(h["Content-Length"]) == len(conv["block"].encode())
    assert warc.derivatives(df.limit(0)).count() == 0


# --- 2 toxicity
def test_ordinal_regression_shares_weights_and_orders_thresholds():
    x = [np.array([0])] * 40 + [np.array([1])] * 40 + [np.array([], dtype=int)] * 120
    y = np.array([1] * 30 + [0] * 10 + [2] * 35 + [1] * 5 + [0] * 120)
    w, th = toxicity.fit_ordinal(x, y, 2, 3)
    assert w[1] > w[0] > 0 and th[0] < th[1]


def test_toxicity_separates_and_generalises_to_inflected_words(spark, empty):
    rows = [(i, prose(i, 40) + (" grobian" + "en" * (i % 3) if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.train(df.select("doc_id", "text"), df.where("doc_id < 300").select("doc_id", "toxic"))
    new = spark.createDataFrame([(1, "ein grobianisch wort", 1), (2, None, 1), (3, "", 2), (4, prose(7, 30), 2)],
                                "doc_id bigint, text string, grade int")
    got = {r["doc_id"]: r for r in toxicity.score(new.drop("grade"), model).collect()}
    assert got[1]["toxic"] and not got[2]["toxic"] and not got[3]["toxic"] and not got[4]["toxic"]
    assert got[1]["expected_severity"] > got[4]["expected_severity"]
    held = toxicity.score(df.where("doc_id >= 300").drop("toxic"), model).toPandas()
    assert (held.toxic == (held.doc_id % 4 == 0)).all()
    nothing = toxicity.train(empty, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert toxicity.score(new.drop("grade"), nothing).where("toxic").count() == 0


# --- 3 SimHash
def brute_simhash(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints_match_brute_force(docs):
    got = simhash.with_fingerprint(docs).select("text", simhash.fingerprint_text(F.col("fp")).alias("f")).collect()
    assert all(r["f"] == f"{brute_simhash(r['text']):016x}" for r in got)


@pytest.mark.parametrize("limit", [2, 256])
def test_classes_match_all_pairs(spark, limit):
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 63, 30).tolist()
    fps = base + [b ^ (1 << int(i)) ^ (1 << int(j)) for b in base[:10] for i, j in r.integers(0, 63, (12, 2))] + [0, 3, 7, 0]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "doc_id bigint, fp bigint")
    got = {(x["doc_id"]): x["component_id"] for x in df.join(simhash.near_duplicates(df, 2, bucket_limit=limit), "fp").collect()}
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in range(len(fps))}


def test_dedup_keeps_one_of_each(docs, empty):
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert 1 in ids and 2 not in ids and ids.count(9) == 1 and 4 in ids and 5 not in ids
    assert simhash.dedup(empty).count() == 0


def test_thresholds_are_the_cheapest():
    costs = [[0, 5.0, 6.0, 50.0], [0, 9.0, 30.0, 90.0], [0, 1.0, 40.0, 90.0]]
    best = min(((a, b, c) for a in range(4) for b in range(4) for c in range(4) if a + b + c == 3),
               key=lambda t: sum(row[i] for row, i in zip(costs, t)))
    assert simhash.allocate(costs, 2) == [x - 1 for x in best]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 501), (None, 3)], "a bigint, b bigint")
    got = dict(map(tuple, components.components(edges).collect()))
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


# --- 4 language model
def test_automaton_matches_recursion(docs, empty):
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    order, kappa = 3, 2.5
    got = backoff_lm.score_documents(docs, held, order, kappa, block_bytes=30_000, shard_bytes=10_000).toPandas()
    count, toks = [collections.Counter() for _ in range(order)], []
    for i, t, _ in TEXTS:
        w = (t or "").encode().lower().split() + [b"\n"]
        out = zlib.crc32(str(i if i is not None else "").encode()) % 10 == 0
        toks.append((i, out, w))
        if not out:
            for k in range(1, order + 1):
                count[k - 1].update(tuple(w[j:j + k]) for j in range(len(w) - k + 1))
    n, v = sum(count[0].values()), len(count[0])

    def p(w, h):
        if not h:
            return (count[0][(w,)] + 0.1) / (n + 0.1 * (v + 1))
        return (count[len(h)][h + (w,)] + kappa * p(w, h[1:])) / (count[len(h) - 1][h] + kappa)
    want = sorted((str(i), out, len(w), sum(count[0][(x,)] > 0 for x in w), n,
                   round(sum(math.log10(p(x, ())) for x in w), 6),
                   round(sum(math.log10(p(w[j], tuple(w[max(0, j - order + 1):j]))) for j in range(len(w))), 6)) for i, out, w in toks)
    have = sorted((str(None if r.doc_id != r.doc_id else int(r.doc_id)), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 6), round(r.score, 6)) for r in got.itertuples())
    assert have == want
    assert backoff_lm.score_documents(empty, held).count() == 0


@pytest.mark.parametrize("most", [0, 255, 256, (1 << 32) - 1, 1 << 32, 1 << 50])
def test_counts_of_any_size_survive(most):
    x = np.array([0, 7, most], dtype=np.int64)
    assert (backoff_lm._from_numbers(backoff_lm._numbers(x)) == x).all()


# --- 5 wrappers
PAGE = ("<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><ul>%s</ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><article><header><h1>Title %d &amp; x</h1></header>%s"
        "<div class=\"ad banner\"><p>Buy</p></div><form><p>Mail</p></form></article><aside>side</aside>"
        "<section id='comments'><p>first!</p></section><footer>end</footer><script>var a='</p>';</script></body></html>")


def test_main_text_without_the_rest(spark):
    rows = []
    for i in range(20):
        body = "".join(f"<p>Para {i}-{k}\n  with <b>bold</b><br>line" for k in range(1 + i % 4))
        rows.append((i, f"http://h{i % 2}.org/{i}", PAGE % ("<li><a>m</a></li>" * (2 + i % 3), i, body)))
    rows += [(90, None, None), (91, "http://h0.org/91", "<article><p>cut off &lt;here"), (91, "http://h0.org/91", "<article><p>cut off &lt;here")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id bigint, url string, html string, wrapper string")
    got = wrappers.extract(df).collect()
    assert len(got) == 23
    text = {r["page_id"]: r["text"] for r in got}
    assert all(text[i] == "\n".join([f"Title {i} & x"] + [f"Para {i}-{k} with bold line" for k in range(1 + i % 4)]) for i in range(20))
    assert text[90] == "" and text[91] == "cut off <here"
    assert wrappers.extract(df.limit(0)).count() == 0


def test_alignment_makes_slots_options_and_repeats():
    a = wrappers.page_nodes("<div><h1>Same</h1><p>x</p><p>y</p><h2>only here</h2></div>")
    b = wrappers.page_nodes("<div><h1>Same</h1><p>z</p></div>")
    w = wrappers.align(a, b)
    assert wrappers.shape(w) == wrappers.shape(wrappers.align(b, a)) == "<div/h1>(<div/p>)+(<div/h2>)?"
    assert w[0][2] == "Same" and w[1][1][0][2] is None
    assert wrappers.shape(wrappers.align(w, b)) == wrappers.shape(w)


def test_fixed_text_is_template_without_an_article(spark):
    rows = [(i, "http://x.com/", f"<div><p>Read our terms</p><div><p>Story {i}</p></div></div>") for i in range(8)]
    got = wrappers.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r["text"] for r in got} == {f"Story {i}" for i in range(8)}


def _texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    return {r.page_id: r.text for r in wrappers.extract(df).collect()}


def test_pages_with_and_without_an_article_on_one_host(spark):
    rows = [(i, f"http://mixed.com/{i}", f"<nav>Menu</nav><article><p>{prose(7000 + i, 30)}</p></article><footer>Foot</footer>")
            for i in range(20)]
    rows.append((99, "http://mixed.com/old", f"<nav>Menu</nav><div><p>{prose(7099, 30)}</p></div><footer>Foot</footer>"))
    got = _texts(spark, rows)
    assert got[99] == prose(7099, 30) and all(got[i] == prose(7000 + i, 30) for i in range(20))


def test_near_copies_and_recurring_headings_are_no_template(spark):
    body = "".join(f"<p>{prose(7200 + j, 20)}</p>" for j in range(3))
    rows = [(i, f"http://near.com/{i}", f"<article>{body}</article><aside>Visits: {i}</aside>") for i in range(6)]
    rows += [(50 + i, f"http://cook.com/{i}", f"<article><h2>Ingredients</h2><p>{prose(7300 + i, 40)}</p><h2>Method</h2>"
              f"<p>{prose(7400 + i, 40)}</p><p>Share this story</p></article>") for i in range(8)]
    got = _texts(spark, rows)
    assert all(got[i] == "\n".join(prose(7200 + j, 20) for j in range(3)) for i in range(6))
    for i in range(8):
        assert got[50 + i] == f"Ingredients\n{prose(7300 + i, 40)}\nMethod\n{prose(7400 + i, 40)}"


@pytest.mark.parametrize("comment", ["<!-->", "<!--->", "<!-- x -->", "<!---->"])
def test_empty_comments_hide_nothing(spark, comment):
    got = _texts(spark, [(1, "http://c.com/", f"<article><p>before {comment} after</p><p>end</p></article>")])
    assert got[1] == "before after\nend"


def test_a_string_of_few_distinct_pages_is_no_template(spark):
    rows = [(i, "http://x.com/", f"<div><h1>Site</h1><p>Story {i}</p></div>" + "<h2>only here</h2>" * (i == 3)) for i in range(8)]
    rows += [(20 + i, "http://copies.com/", "<div><h1>Head</h1><p>Body</p></div>") for i in range(7)]
    got = wrappers.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert text == {i: f"Story {i}" + "\nonly here" * (i == 3) for i in range(8)} | {20 + i: "Head\nBody" for i in range(7)}


def test_long_streams_align_by_the_longest_subsequence():
    r = np.random.default_rng(5)
    for n, m in ((9, 7), (60, 80), (900, 700)):
        a, b = (list(map(str, r.integers(0, 3, k))) for k in (n, m))
        size = np.zeros((n + 1, m + 1), int)
        for i in range(n):
            for j in range(m):
                size[i + 1, j + 1] = size[i, j] + 1 if a[i] == b[j] else max(size[i, j + 1], size[i + 1, j])
        got = wrappers._common(a, b)
        assert len(got) == size[n, m] and all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


def test_template_inside_an_article_goes_by_its_place(spark):
    rows = []
    for i in range(12):
        body = "".join(f"<p>Text {i}-{k}</p>" for k in range(1 + i % 3)) + ("<p>Story of the day</p><p>more</p>" if i == 3 else "")
        notice = "<p>All rights reserved</p>" if i % 4 else ""
        rows.append((i, "http://n.com/", f"<article><p>Story of the day</p><div>By the desk</div>{body}<p>Share this</p>{notice}</article>"))
    got = wrappers.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    for r in got:
        i = r["page_id"]
        assert r["text"].split("\n") == [f"Text {i}-{k}" for k in range(1 + i % 3)] + ["Story of the day", "more"] * (i == 3)


def test_marks_are_whole_names_and_never_reject_the_article(spark):
    inner = "<header class='entry-header'><h1>T%d</h1></header><p>Body %d</p><div class='share'>Share %d</div>"
    forms = ["<div class='layout has-sidebar'><article>%s</article></div>", "<main class='no-sidebar'>%s</main>",
             "<article class='post comments-open'>%s</article>", "<div id='search-results'><main>%s</main></div>",
             "<div class='with-header'><article>%s</article></div>", "<form id=f><main>%s</main></form>",
             "<article>%s</article><section id=comments><article><p>Reply</p></article></section>",
             "<article class='related'>%s</article>"]
    rows = [(10 * k + i, f"http://m{k}.com/", f % (inner % (i, i, i))) for k, f in enumerate(forms) for i in range(6)]
    got = wrappers.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert all(r["text"] == "T{0}\nBody {0}".format(r["page_id"] % 10) for r in got) and len(got) == len(rows)


# --- 6 packing
def test_plan_is_best_fit_decreasing():
    r = np.random.default_rng(3)
    for _ in range(60):
        window = int(r.choice([8, 16, 100]))
        items = r.integers(1, window + 1, int(r.integers(0, 90))).tolist()
        rooms = []
        for n in sorted(items, reverse=True):
            fit = [(room, i) for i, room in enumerate(rooms) if room >= n]
            if fit:
                rooms[min(fit)[1]] -= n
            else:
                rooms.append(window - n)
        steps = packing.plan(collections.Counter(items), window)
        held = collections.defaultdict(list)
        for n, lo, hi, first, at in steps:
            for k in range(lo, hi):
                held[first + k - lo].append((at, n))
        assert len(held) == len(rooms) and sum(len(v) for v in held.values()) == len(items)
        for v in held.values():
            end = 0
            for at, n in sorted(v):
                assert at == end
                end += n
            assert end <= window


def test_pieces_round_trip(docs, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    got = packing.pack(docs, tokenizer_path(), window=256, with_ids=True).toPandas()
    want = collections.Counter()
    for i, t, _ in TEXTS:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for s in range(0, len(ids), 256):
            part = ids[s:s + 256]
            want[(str(i), s, tuple(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids))] += 1
    have = collections.Counter((str(None if r.doc_id != r.doc_id else int(r.doc_id)), r.start, tuple(r.ids), r.ids_crc32, r.doc_tokens)
                               for r in got.itertuples())
    assert have == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset == g.length.cumsum() - g.length).all() and g.length.sum() <= 256
    assert packing.pack(empty, tokenizer_path()).count() == 0


@pytest.mark.parametrize("text", [
    "a\n \nb", "a  b", "a \n b", "x\n\ny z", "I'll don't' we've", " a b c", " lead", "trail ", "\n", "12.5% 3rd",
    "a\x1cb \x1cc", "日本語 テキスト。", "word.\n- item", "a\r\nb c", "x\n'll y", "é áb"])
def test_encoder_equals_the_tokenizer(text):
    enc = packing.encoder(tokenizer_path())
    assert enc.encode(text) == np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


# --- 7 URL reputation
URLS = ["http://A.Example.ORG/en/12?q", "https://x.example.org/es/", "http://org", "ftp://m.com/de/1#x", "http://b.com/fr/", None,
        "nothing", "http://b.net/?x", "http://b.com:80/de/9", "http://notexample.org/es/1", "http://example.org?/es/"]


def test_rules_longest_wins(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id bigint, url string, verdict string")
    got = {r["page_id"]: r for r in url_reputation.judge(df, RULES).collect()}
    for i, u in enumerate(URLS):
        rest = (u or "").partition("://")[2]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = host.lower()
        fits = [(len(r), r, v) for v, r in RULES if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0]))
                and path.startswith("/" + r.partition("/")[2])]
        rule = max(fits, default=(0, None, None))
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule[1])
        if rule[2]:
            assert got[i]["verdict"] == rule[2]
    assert url_reputation.judge(df.limit(0), RULES).count() == 0


def test_reputation_shrinks_along_the_chain(spark):
    rows = [(f"h{i}.bad.com", 50, 48) for i in range(4)] + [(f"h{i}.good.com", 50, 1) for i in range(4)] \
        + [("new.bad.com", 0, 0), ("new.good.com", 0, 0), ("one.other.net", 1, 1)]
    got = {r["host"]: r for r in url_reputation.reputation(spark.createDataFrame(rows, "host string, n bigint, blocked bigint")).collect()}
    assert got["new.bad.com"]["rate"] > 0.7 > 0.3 > got["new.good.com"]["rate"]
    assert got["h0.bad.com"]["bound"] > 0.5 and got["h0.good.com"]["bound"] < 0.1
    assert got["one.other.net"]["bound"] < 0.5 < got["one.other.net"]["rate"]        # one page is no proof


# --- 8 mixing
def test_sainte_lague_takes_the_highest_quotients():
    r = np.random.default_rng(8)
    for _ in range(50):
        votes, seats = r.integers(0, 1000, int(r.integers(1, 12))).tolist(), int(r.integers(0, 60))
        heap, want = [(-v, i, 0) for i, v in enumerate(votes) if v], [0] * len(votes)
        heapq.heapify(heap)
        for _ in range(seats if any(votes) else 0):
            q, i, s = heapq.heappop(heap)
            want[i] += 1
            heapq.heappush(heap, (-votes[i] / (2 * s + 3), i, s + 1))
        got = mixing.sainte_lague(votes, seats)
        assert got.sum() == sum(want) and max(abs(got - want), default=0) <= 1


def test_mix_meets_targets(docs, empty):
    a, b = (mixing.mix(d).toPandas() for d in (docs, docs.repartition(2, "text")))
    assert sorted(map(str, a.values.tolist())) == sorted(map(str, b.values.tolist()))
    assert list(a["size"].sort_values()) == sorted(len(split(t)) for _, t, _ in TEXTS)
    by = a.assign(k=a.source_size).groupby("k").agg(t=("target", "first"), n=("taken", "sum"))
    assert ((by.t - by.n).abs() <= 8).all() and (a.taken <= 3 * a["size"]).all()
    whole = mixing.mixed_documents(docs).toPandas()
    assert sum(len(split(t)) for t in whole.text) == a.taken.sum() and list(whole.columns) == docs.columns
    assert mixing.mix(empty).count() == 0


def test_small_sources_meet_targets_beside_a_large_one(spark):
    data = [(i, "word " * (1 + i % 2), "a") for i in range(200)] + [(1000 + i, prose(i, 40), "b") for i in range(4000)]
    got = mixing.mix(spark.createDataFrame(data, "doc_id bigint, text string, source string"), shard_docs=10).toPandas()
    by = got.groupby("source_size").agg(t=("target", "first"), n=("taken", "sum"))
    assert ((by.t - by.n).abs() <= 8).all() and by.t.iloc[0] == 900 and (got.taken <= 3 * got["size"]).all()


def test_blocks_beyond_a_shard_go_to_others():
    r = np.random.default_rng(3)
    for _ in range(200):
        words = r.integers(0, 30, int(r.integers(1, 40)))
        quota = int(r.integers(0, words.sum() * 3 // 8 + 1))
        got = mixing.deal_blocks(words, quota, 3, 8)
        assert abs(np.minimum(got * 8, words * 3).sum() - quota * 8) < 8 and (got * 8 < words * 3 + 8).all()


def test_targets_stop_at_the_cap():
    assert mixing.targets([10, 1000, 10], [5, 2, 1], 3) == [30.0, 960.0, 30.0]


# --- 9 multiset hash
def test_fingerprints_and_edited_texts(docs, empty):
    got = multiset_hash.fingerprints(docs).toPandas()
    rows = sorted(TEXTS, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for k, (i, t, _) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 3
        sha = hashlib.sha256((t[:len(t) - cut] + nxt[:cut]).encode()).hexdigest()
        mine = got[got.doc_id.isna()] if i is None else got[got.doc_id == i]
        assert sha in set(mine.edited_sha256) and (mine.n_chars == len(t)).all()
    f = {r.doc_id: r.fingerprint for r in got.itertuples()}
    assert f[1] == f[2] != f[3] and f[4] == f[5] and f[7] != f[8]
    assert got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    assert multiset_hash.fingerprints(empty).count() == 0
    one = multiset_hash.fingerprints(docs.where("doc_id = 3")).first()
    assert one["near_next"] == 1.0


def test_multiset_hash_is_homomorphic(spark):
    a, b = "One here. Two there.\nThree.\n", "Four is more. Five!\n"
    df = spark.createDataFrame([(a, b, a + b, b + a)], "a string, b string, ab string, ba string").select(
        *[multiset_hash.fingerprint(F.col(c)).alias(c) for c in ("a", "b", "ab", "ba")])
    r = df.select("*", multiset_hash.insert(F.col("a"), F.col("b")).alias("sum"),
                  multiset_hash.delete(F.col("ab"), F.col("b")).alias("rest"),
                  multiset_hash.likeness(F.col("ab"), F.col("ba")).alias("same"),
                  multiset_hash.likeness(F.col("a"), F.col("ab")).alias("part")).first()
    assert r["sum"] == r["ab"] == r["ba"] and r["rest"] == r["a"] and r["same"] == 1.0 and 0.3 < r["part"] < 1.0


def test_range_cuts_do_not_change_successors(docs):
    few, many = (sorted(map(str, multiset_hash.with_next(docs, part_bytes=n).select("doc_id", "text", "next_text").collect()))
                 for n in (1 << 30, 2000))
    assert few == many


def test_one_id_or_null_may_fill_many_ranges(spark):
    data = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"Text {i % 250}. " * (i % 7)) for i in range(600)]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    few, many = (sorted(map(str, multiset_hash.with_next(df, part_bytes=n).select("doc_id", "text", "next_text").collect()))
                 for n in (1 << 30, 8000))
    assert few == many and len(few) == 600


def test_cuts_of_two_levels_split_a_heavy_id(spark):
    keys = spark.range(2000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
                                    F.xxhash64("id").alias("tie"), F.lit(1000).cast("bigint").alias("size"))
    one, two = (multiset_hash._cuts(keys, 40, 1000, coarse=c) for c in (1000, 10))
    assert len(one) == 39 and one.count(-1) == 13 and two == sorted(two) and 33 <= len(two) <= 45 and two.count(-1) >= 10


def test_likeness_weighs_pieces_by_their_multiplicities(spark):
    def dice(a, b):
        a, b = collections.Counter(a), collections.Counter(b)
        return 2 * sum(n * b[p] for p, n in a.items()) / sum(n * n for x in (a, b) for n in x.values())
    r = np.random.default_rng(8)
    cases = [(["same\n"] * 900, ["same\n"] * 600 + [f"{i}\n" for i in range(300)]),
             ([f"{i}\n" for i in range(1000)], [f"{i}\n" for i in range(500, 1500)])]
    cases += [tuple([f"{int(x)}\n" for x in r.integers(0, 60, 400)] for _ in range(2)) for _ in range(5)]
    cases += [([f"{i}\n" for i in range(1_000_000)], [f"{i}\n" for i in range(250_000, 1_250_000)])]
    df = spark.createDataFrame([(i, "".join(a), "".join(b)) for i, (a, b) in enumerate(cases)], "i int, a string, b string")
    got = df.select("i", multiset_hash.likeness(multiset_hash.fingerprint(F.col("a")), multiset_hash.fingerprint(F.col("b")))).collect()
    for i, x in got:
        want = dice(*cases[i])
        assert abs(x - want) < 4 * 0.127 * (1 - want) + 1e-9, (i, x, want)


# --- 10 line frequency
def brute_counts(t):
    t = t or ""
    words = split(t)
    lines = [x for x in t.split("\n") if split(x)]
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_base_counts_match_brute_force(docs):
    got = line_frequency.base_counts(docs).select("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert len(got) == len(TEXTS)
    assert all(tuple(r)[1:] == brute_counts(r["text"]) for r in got)


@pytest.mark.parametrize("rows", [0, 100_000])
def test_frequent_lines_go_and_depleted_documents_are_rejected(spark, rows):
    shared = "Subscribe NOW to issue 17 of our letter"
    data = [(i, f"{prose(i, 30)}\n  {shared.lower() if i % 2 else shared}\n{prose(i + 1000, 30)}", "s") for i in range(40)]
    data += [(100, "\n".join([shared, prose(77, 25)]), "s"), (101, "\n".join([shared] * 4), "s"), (102, None, None)]
    data += [(200 + i, prose(5000, 50), "s") for i in range(60)]           # copies are documents too
    data += [(300 + i, prose(6000, 50), "s") for i in range(10)]           # ten are not above the limit
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r for r in line_frequency.filter_lines(df, broadcast_rows=rows).collect()}
    assert all(got[i]["kept"] and shared.lower() not in got[i]["clean_text"].lower() and got[i]["words_left"] == 60 for i in range(40))
    assert got[100]["kept"] and not got[101]["kept"] and not got[102]["kept"]
    assert not any(got[200 + i]["kept"] or got[200 + i]["words_left"] for i in range(60))
    assert all(got[300 + i]["kept"] and got[300 + i]["n_removed_lines"] == 0 for i in range(10))


@pytest.mark.parametrize("rows", [0, 100_000])
def test_the_limit_of_a_line_does_not_rise_with_the_source(spark, rows):
    for n in (40, 2500):
        data = [(i, "\n".join([prose(i, 30)] + ["Licensed under CC"] * (i < 11) + ["Rare line"] * (i < 10)), "s") for i in range(n)]
        df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
        got = line_frequency.filter_lines(df, broadcast_rows=rows).where("n_removed_lines > 0").select("doc_id", "clean_text").collect()
        assert {r["doc_id"] for r in got} == set(range(11)) and not any("Licensed" in r["clean_text"] for r in got)
        assert sum("Rare line" in r["clean_text"] for r in got) == 10


def test_line_filter_on_clashing_and_empty_tables(docs, empty):
    assert line_frequency.filter_lines(empty).count() == 0
    theirs = ["_own", "_OWN", "__own", "_frequent", "_kept_lines", "_host_key", "_text_key", "_t", "_f", "_k"]
    odd = docs.withColumns({c: F.lit(c) for c in theirs if c != "_OWN"}).withColumn("n_words", F.lit("mine"))
    for rows in (0, 100_000):
        got = line_frequency.filter_lines(odd, broadcast_rows=rows).collect()
        assert len(got) == len(TEXTS) and all(r[c] == c for r in got for c in theirs if c != "_OWN")
        assert {r["text"]: r["n_words"] for r in got} == {t: brute_counts(t)[0] for _, t, _ in TEXTS}


def test_buckets_hold_each_frequent_line_once(spark):
    found = spark.range(5000).select((F.col("id") % 3).cast("string").alias("host"), F.xxhash64("id").alias("line_hash"))
    got = line_frequency.bucketed(found, ["host"], "b").collect()
    want = collections.defaultdict(set)
    for r in found.collect():
        want[r["host"]].add(r["line_hash"])
    for r in got:
        n = len(r["b"])
        assert n == len(want[r["host"]]) // 8 + 1 and {h for b in r["b"] for h in b} == want[r["host"]]
        assert all(h % n == i for i, b in enumerate(r["b"]) for h in b) and max(map(len, r["b"])) < 40


def test_blocks_supply_left_out_closing_tags():
    got = list(html_tokens.blocks("<div><p>a<p>b<ul><li>c<li>d</ul>e<!-- <p>x</p> --></div>"))
    assert [t for _, t in got] == ["a", "b", "c", "d", "e"]


def test_embedded_elements_hide_no_text():
    page = ("<article><p>a <svg class=icon/> b <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p><object data=o><p>other</p>"
            "<canvas>c</canvas><object-view>d</object-view><style-guide>e</style-guide><p>f<math/>g</p>"
            "<iframe title='>' src='/in'>raw</iframe><script>var a='</p>';</script><p>end</p></article>")
    assert [t for _, t in html_tokens.blocks(page)] == ["a b x=1", "other", "c", "d", "e", "fg", "end"]
    assert warc.links(page) == ["iframe@src /in"]
    got = {r[0]: r[-1] for r in warc.derive("r", "u", None, "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + page, None, None, "s")}
    assert got["conversion"].endswith("fg\nend") and "outlink: iframe@src /in" in got["metadata"]
