"""The corpus pipeline and registered queries over whole small tables, stage by stage."""
import collections
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as P
from txnscope.llm import queries as Q
from txnscope.llm.common import table
from tests.conftest import SF_CHECK, SF_SMALL

WORD = "[^\\x20\\x09-\\x0D]+"


@pytest.fixture(scope="module")
def stages(spark):
    """Input, then what each stage returns, with rows of awkward kinds and a clashing column added to the documents."""
    docs = table(spark, SF_SMALL, "documents")
    odd = [(10 ** 6 + i, t, s) for i, (t, s) in enumerate([(None, None), ("", "x"), (" \t", None), ("word " * 30000, "x")])]
    more = spark.createDataFrame(odd, "doc_id bigint, text string, source string")
    out = [docs.unionByName(more, allowMissingColumns=True).withColumn("kept", F.lit(7)).cache()]
    for _, stage in P.STAGES:
        out.append(stage(spark, out[-1], SF_SMALL).cache())
    return out


def test_filters_keep_whole_rows_of_their_input(stages):
    for before, after in zip(stages[:3], stages[1:4]):
        assert after.columns == before.columns and after.count() < before.count() + 1
        assert after.join(before.select("doc_id").distinct(), "doc_id", "left_anti").count() == 0
        assert after.where("kept <> 7").count() == 0


def test_toxicity_rejects_what_the_model_rejects(spark):
    docs = table(spark, SF_CHECK, "documents")
    toxic = Q.toxicity_severity(spark, SF_CHECK).where("toxic").select("doc_id")
    kept = P.without_toxic(spark, docs, SF_CHECK)
    assert 0 < toxic.count() == docs.count() - kept.count() and kept.join(toxic, "doc_id").count() == 0


def test_one_document_of_each_near_duplicate_class(stages):
    def fingerprint(text):
        import re
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        if not words:
            return 0
        shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    rows = [(r.doc_id, fingerprint(r.text)) for r in stages[2].select("doc_id", "text").collect()]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 2:
                parent[root(i)] = root(j)
    classes = collections.defaultdict(set)
    for i, (doc, _) in enumerate(rows):
        classes[root(i)].add(doc)
    kept = [r.doc_id for r in stages[3].select("doc_id").collect()]
    assert len(kept) == len(classes) and all(len(c & set(kept)) == 1 for c in classes.values())


def test_pieces_hold_every_token_of_the_mix_once(stages):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(Q.tokenizer_path())
    pieces = stages[5].collect()
    ids = {}
    for r in stages[4].select("doc_id", "text").collect():
        ids.setdefault(r.doc_id, []).append([*tok.encode(r.text or "", add_special_tokens=False).ids, 0])
    by_sequence = collections.defaultdict(list)
    for p in pieces:
        # The mix may take a document whole and in part: the piece is of one of its texts.
        parts = [x[p.start:p.start + p.length] for x in ids[p.doc_id] if len(x) == p.doc_tokens]
        assert p.length > 0 and any(len(x) == p.length and p.ids_crc32 == zlib.crc32(
            b"".join(i.to_bytes(4, "little") for i in x)) for x in parts)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    assert sum(p.length for p in pieces) == sum(len(x) for v in ids.values() for x in v)
    for s in by_sequence.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024


def test_empty_documents_give_empty_stages(spark, stages):
    docs = stages[0].where("doc_id < 0")
    for name, stage in P.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0, name


def test_fingerprint_classes_of_the_registered_query(spark):
    got = Q.simhash_classes(spark, SF_SMALL).collect()
    fps = {r.doc_id: int(r.fingerprint, 16) for r in got}
    assert len(got) == table(spark, SF_SMALL, "documents").count()
    # Links are closed: no two rows within two bits have different classes, and a class's id is its smallest row.
    items = sorted(fps.items())
    comp = {r.doc_id: r.component_id for r in got}
    for i, (a, x) in enumerate(items):
        for b, y in items[:i]:
            if (x ^ y).bit_count() <= 2:
                assert comp[a] == comp[b]
    for c in set(comp.values()):
        assert c == min(d for d, k in comp.items() if k == c)


def test_mixed_words_come_near_their_targets(spark):
    got = Q.source_mix(spark, SF_SMALL).collect()
    words = {r.doc_id: r.n for r in table(spark, SF_SMALL, "documents").select(
        "doc_id", F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})"))).alias("n")).collect()}
    sources = {r.doc_id: r.source for r in table(spark, SF_SMALL, "documents").select("doc_id", "source").collect()}
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        assert r.size == words[r.doc_id] and r.taken <= 3 * r["size"]
        size[sources[r.doc_id]] += r["size"]
        taken[sources[r.doc_id]] += r.taken
        target[sources[r.doc_id]] = r.target
    names = sorted((s for s in size), key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want, free, total = {}, set(names), sum(size.values())
    while True:
        rest = total - sum(want.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]}
        if not over:
            want |= share
            break
        want |= {s: 3.0 * size[s] for s in over}
        free -= over
    for s in names:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - want[s]) <= max(20, 0.02 * want[s])
