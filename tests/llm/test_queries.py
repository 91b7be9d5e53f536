"""The operators' registered queries: against SQL where there is some, else against brute force, on whole tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from oracle import connect, differences

from paceline.llm.queries import ORACLE, QUERIES
from paceline.session import prepare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


@pytest.fixture(scope="module")
def rows(spark):
    prepare(spark)
    kept = {}
    return lambda name: kept.setdefault(name, QUERIES[name](spark, SF).collect())


@pytest.mark.parametrize("name", ORACLE)
def test_same_rows_as_sql(spark, tables, name):
    expected_names, names, missing, extra = differences(tables, QUERIES[name](prepare(spark), SF), ORACLE[name])
    assert names == expected_names
    assert not missing and not extra


def test_mix_meets_targets(rows, tables):
    docs = tables.execute("SELECT doc_id, source, coalesce(text, '') FROM documents").fetchall()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, _, t in docs}
    source = {i: s for i, s, _ in docs}
    sizes = Counter()
    for i, s in source.items():
        sizes[s] += size[i]
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(sizes))}
    target, free, rest = {}, set(sizes), sum(sizes.values())
    while free:
        share = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3 * sizes[s]
            free.discard(s)
            rest -= 3 * sizes[s]
    taken = Counter()
    found = rows("op1_source_mix")
    assert sorted(r.doc_id for r in found) == sorted(size)
    for r in found:
        s = source[r.doc_id]
        assert (r["size"], r.source_size) == (size[r.doc_id], sizes[s]) and 0 <= r.taken <= 3 * r["size"]
        assert r.target == pytest.approx(target[s])
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)


def test_quality_on_held_out_rows(spark):
    more = "/root/testdata/sf0.01"
    tables = connect(more)
    labels = dict(tables.execute("SELECT doc_id, quality FROM labels").fetchall())
    found = QUERIES["op4_quality"](prepare(spark), more).collect()
    assert len(found) == tables.execute("SELECT count(*) FROM documents").fetchone()[0]
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    told = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in told]) >= 0.95
    assert np.mean([a == 1 for a, b in told if b == 1]) >= 0.98


def encoding():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_library(rows, tables):
    texts = dict(tables.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    whole = encoding()
    found = rows("op8_bpe")
    assert len(found) == len(texts)
    for r in found:
        ids = np.array(whole.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


PLANTED = r"[\w.]+@[\w.]+\w|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])|AKIA\w{16}|\(\d{3}\) \d{3}-\d{4}|password=\w+|token = \"\w+"


def test_no_personal_data_is_left(rows, tables):
    texts = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    renamed = defaultdict(set)
    for r in rows("op9_pii"):
        old, new = texts[r.doc_id], r.text
        assert re.sub(r"\S*\d\S*", "", old) == re.sub(r"\S*\d\S*", "", new)
        before, after = re.findall(PLANTED, old), re.findall(PLANTED, new)
        assert len(before) == len(after) and not set(before) & set(after)
        for a, b in zip(before, after):
            renamed[a].add(b)
    assert renamed and all(len(v) == 1 for v in renamed.values())
    assert len({next(iter(v)) for v in renamed.values()}) == len(renamed)


def test_pipeline(spark, tables):
    import corpus_pipeline
    from paceline.llm.tables import stored

    prepare(spark)
    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test")
        kept[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == first.columns
    good, single, clean, mix, ids = (kept[n].collect() for n, _ in corpus_pipeline.STAGES)
    labels = dict(tables.execute("SELECT doc_id, quality FROM labels").fetchall())
    passed = {r.doc_id for r in good}
    assert np.mean([(i in passed) == (q == 1) for i, q in labels.items()]) >= 0.85

    def shingles(text):
        words = text.encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {r.doc_id: shingles(r.text or "") for r in good}
    group = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    assert sorted(r.doc_id for r in single) == sorted(i for i, g in group.items() if i == g)
    assert sorted(r.doc_id for r in clean) == sorted(r.doc_id for r in single)
    assert {r.doc_id for r in mix} <= {r.doc_id for r in clean}
    whole = encoding()
    texts = {r.doc_id: r.text for r in mix}
    assert len(ids) == len(mix) and all(r.round_trip for r in ids)
    for r in ids:
        assert bytes(r.ids) == np.array(whole.encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
