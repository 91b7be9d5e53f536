"""Spelling variants, document fingerprints and the Merkle manifest: brute force and defined results."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paceline.llm import fingerprints as fp
from paceline.llm import merkle, spelling
from paceline.llm.queries import QUERIES
from paceline.session import prepare

SF = "/root/testdata/sf0.001"

# --- 11: spelling variants ---------------------------------------------------------------------


def brute_near(counts):
    words = sorted(counts)
    near = {w: [] for w in words}
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if spelling._one_apart(a, b):
                near[a].append(b)
                near[b].append(a)
    return near


def edits_one(a, b):
    """Exactly one edit apart, by the definition."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def made_words(seed, many):
    random.seed(seed)
    words = {"".join(random.choice("abcdé") for _ in range(random.randint(1, 6))) for _ in range(many)}
    words |= {"x" * 70, "x" * 69, "x" * 69 + "y", "x" * 30 + "z" + "x" * 39, "y" + "x" * 300, "x" * 300, "e" * 260, "e" * 261, "\U0001f600a", "a"}
    return {w: random.randint(1, 40) for w in words}


def test_one_edit_by_its_definition():
    words = sorted(made_words(1, 150))
    held = spelling.Words(words)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    expected = [edits_one(words[a], words[b]) for a, b in zip(i, j)]
    assert [spelling._one_apart(words[a], words[b]) for a, b in zip(i, j)] == expected
    assert held.near(i, held, j).tolist() == expected


def test_trie_finds_what_keeps_the_budget(monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 50)
    rng = np.random.default_rng(2)
    vectors = np.zeros((300, spelling.GROUPS), "u1")
    vectors[:, :5] = rng.integers(0, 3, (300, 5))
    vectors[:5, 31] = [255, 254, 253, 255, 0]
    more = vectors[:, None].astype(int) - vectors[None]
    expected = ((np.maximum(more, 0).sum(2) <= 1) & (np.maximum(-more, 0).sum(2) <= 1)).nonzero()
    found = [(a, b) for q, e in spelling.Trie(vectors).search(vectors) for a, b in zip(q.tolist(), e.tolist())]
    assert len(found) == len(set(found))
    assert set(found) == set(zip(*(x.tolist() for x in expected)))
    assert list(spelling.Trie(vectors[:0]).search(vectors)) == [] and list(spelling.Trie(vectors).search(vectors[:0])) == []


@pytest.mark.parametrize("limit,visitors", [(1 << 15, 1 << 17), (20, 35)])
def test_variants_like_brute_force(spark, limit, visitors):
    counts = made_words(3, 400)
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: r for r in spelling.variants(table, limit=limit, visitors=visitors).collect()}
    assert sorted(found) == sorted(counts)
    near = brute_near(counts)
    forms = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= 2 * counts[w] else None
    for w, r in found.items():
        root = w
        while forms[root]:
            root = forms[root]
        assert (r.n, r.n_near, r.form, r.root, r.form_n) == (counts[w], len(near[w]), forms[w], root, counts.get(forms[w]))


def test_top_nodes_hold_every_word_once(spark):
    counts = made_words(4, 500)
    vectors = spelling._vectors(list(counts))
    table = spark.createDataFrame([(bytearray(v.tobytes()),) for v in vectors], "counts binary")
    ways = spelling._top(table, len(counts), 10)
    assert len(ways) > 20
    assert all(sum(v.tobytes().startswith(w) for w in ways) == 1 for v in vectors)


def test_words_of_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "Éclair éclair ÉCLAIR", "x"), (3, "w" * 200_000 + " straße×x straße×x", "x"), (4, "straße×x", "x"), (4, "straße×x", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    expected = {}
    for i, text, _ in rows:
        for run in __import__("re").findall("[A-Za-zÀ-ÿ]+", (text or "").translate(str.maketrans(spelling.UPPER, spelling.LOWER))):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            word = run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(word) >= 5:
                expected[word] = expected.get(word, 0) + 1
    assert {r.word: r.n for r in spelling.word_counts(docs, least=1).collect()} == expected
    assert expected["straße×x"] == 4
    assert spelling.variants(spelling.word_counts(docs.limit(0))).count() == 0


# --- 12: document fingerprints -------------------------------------------------------------------


def plain_fingerprint(text):
    """The walks step by step, one character at a time."""
    mix = lambda x: int(fp._mix(np.array([x % 2**64], "u8"))[0])
    kinds = fp._kinds()
    values = [0] * fp.SAMPLES
    for walk, (steps, samples) in enumerate(fp._records()):
        at, t, path = 0, 0, []
        while at < len(text):
            path.append(at)
            coin = int(kinds[ord(text[at])]) % fp.KINDS
            at += mix(mix(t % fp.PERIOD) ^ (coin << 32) ^ ((fp.SEED << 48) + (walk << 40))) & 1
            t += 1
        for k in set(samples.tolist()):
            mine = [s for s in steps[samples == k].tolist() if s < len(path)]
            if mine:
                written = 0
                for back in range(fp.WINDOW):
                    i = path[mine[-1]] - back
                    written = written << 8 | (int(kinds[ord(text[i])]) if i >= 0 else 0)
                values[k] = mix(written ^ (k << 40)) % 255 + 1
    return bytes(values).hex()


def test_fingerprint_like_the_plain_walk(monkeypatch):
    random.seed(1)
    texts = ["", "a", "ab", "\U0001f600é", "".join(random.choice("abc é\n") for _ in range(700))]
    expected = [plain_fingerprint(t) for t in texts]
    assert [fp.fingerprint(t) for t in texts] == expected
    assert expected[0] == "00" * fp.SAMPLES and all("00" not in [p[i : i + 2] for i in range(0, 256, 2)] for p in expected[1:])
    monkeypatch.setattr(fp, "SLICE", 7)
    assert [fp.fingerprint(t) for t in texts] == expected


def share(a, b):
    return np.mean([a[i : i + 2] == b[i : i + 2] for i in range(0, len(a), 2)])


def test_likeness_follows_what_texts_share():
    random.seed(2)
    text = lambda n: "".join(random.choice("etaoin shrdlu") for _ in range(n))
    edited, apart, small = [], [], []
    for n in random.choices(range(300, 3000), k=60):
        one, other = text(n), text(n)
        mine = fp.fingerprint(one)
        half = one[: n - n // 2] + other[: n // 2]
        edited.append(share(mine, fp.fingerprint(half)))
        apart.append(share(mine, fp.fingerprint(other)))
        at = random.randrange(n)
        small.append(share(mine, fp.fingerprint(one[:at] + "X" + one[at:])))
    assert 0.4 < np.mean(edited) < 0.6 and min(edited) > 0.25 and max(apart) < 0.1 and np.mean(small) > 0.85


def test_op12_like_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(docs)
    found = QUERIES["op12_fingerprints"](prepare(spark), SF).collect()
    assert sorted(r.doc_id for r in found) == ids
    for r in found:
        text, after = docs[r.doc_id], docs[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        mine, other = fp.fingerprint(text), fp.fingerprint(edited)
        assert (r.n_chars, r.fingerprint, r.edited_fingerprint) == (len(text), mine, other)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.near_edited, r.near_next) == (share(mine, other), share(mine, fp.fingerprint(after)))
        assert r.bands_met == sum(mine[i : i + 8] == other[i : i + 8] for i in range(0, 256, 8))
    assert np.mean([r.near_edited for r in found]) > 0.4 and np.median([r.near_next for r in found]) < 0.1


def test_next_of_odd_rows(spark):
    rows = [(None, None, "f"), (1, "", "f"), (2, "ab", "f"), (2, "ab", "f"), (3, "word " * 50_000, "f"), (7, "z", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(3)
    found = sorted(((r.doc_id or 0, r.n_chars, r.edited_sha256, r.near_next) for r in fp.with_next(docs).collect()))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    third = share(fp.fingerprint("word " * 50_000), fp.fingerprint("z"))
    long, ab = "word " * 50_000, fp.fingerprint("ab")
    assert found == sorted([
        (0, 0, sha(""), 1.0), (1, 0, sha(""), 0.0), (2, 2, sha("aa"), 1.0), (2, 2, sha("aw"), share(ab, fp.fingerprint(long))),
        (3, 250_000, sha(long[:125_000] + "z"), third), (7, 1, sha("z"), 0.0)])
    assert fp.with_next(docs.limit(0)).count() == 0
    assert [r.near_next for r in fp.with_next(docs.filter("doc_id = 7")).collect()] == [1.0]


def test_search_finds_near_texts(spark):
    random.seed(5)
    text = lambda n: "".join(random.choice("etaoin shrdlu") for _ in range(n))
    rows = []
    for i in range(60):
        one = text(random.randint(200, 1500))
        at = random.randrange(len(one))
        rows += [(i, one), (100 + i, one[:at] + "Q" + one[at + 1 :])]
    rows += [(500, rows[0][1]), (600, None), (601, "")]
    docs = fp.fingerprints(spark.createDataFrame([(*r, "old") for r in rows], "doc_id long, text string, fingerprint string"))
    found = {(r.query_id, r.doc_id): r.distance for r in fp.search(docs.filter("doc_id < 60"), docs, edits=1).collect()}
    expected = {(i, 100 + i): 1 for i in range(60)} | {(0, 500): 0}
    assert set(found.items()) <= set(expected.items()) and len(found) >= 0.95 * len(expected)
    assert all(a != b for a, b in found)
    assert fp.search(docs.limit(0), docs).count() == 0


# --- 13: Merkle manifest ---------------------------------------------------------------------------


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climbed(level):
    """The levels of a tree over a list of digests."""
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def beside(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 8 * 8
        out += [h for i, h in enumerate(level[first : first + 8], first) if i != at]
        at //= 8
    return out


ROWS = (
    [(i, "en", f"leaf {i}") for i in range(75)] + [(i, "de", f"t {i}") for i in range(8)] + [(3, "fr", "x")]
    + [(None, None, "nul"), (None, None, "nul"), (2, None, "two"), (5, "ï", "acc"), (5, "ï", "acc")] + [(i, f"g{i:02}", "g") for i in range(20)]
)


def built(spark, rows):
    table = spark.createDataFrame([(*r, digest(r[2]), 1, 2, 3) for r in rows], "doc_id long, lang string, text string, leaf string, pos int, part int, n2 int")
    tampered = F.when(F.col("doc_id") % 3 == 0, F.sha2("text", 224)).alias("tampered")
    return merkle.manifest(table.select("*", tampered), "lang", ["doc_id"], keep=["tampered", "n2"])


@pytest.mark.parametrize("run", [7, 1 << 14])
def test_proofs_like_brute_force(spark, monkeypatch, run):
    monkeypatch.setattr(merkle, "RUN", run)
    made = built(spark, ROWS)
    groups = {}
    for i, lang, text in sorted(ROWS, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, digest(r[2]))):
        groups.setdefault(lang, []).append((i, digest(text)))
    trees = {lang: climbed([h for _, h in rows]) for lang, rows in groups.items()}
    top = climbed([levels[-1][0] for levels in trees.values()])
    assert made.root == top[-1][0]
    proved = merkle.prove(made, made.rows).join(made.roots, "tree").collect()
    expected = {}
    for t, (lang, rows) in enumerate(groups.items()):
        for at, (i, h) in enumerate(rows):
            proof = digest("".join(beside(trees[lang], at) + beside(top, t)))
            expected.setdefault((lang, i, h, trees[lang][-1][0]), []).append(proof)
    found = {}
    for r in proved:
        found.setdefault((r.lang, r.doc_id, r.leaf, r.subroot), []).append(r.proof_sha256)
        assert (r.folded_root == made.root) == (r.tampered is None) and r.n2 == 3
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    # Proofs of any part of the leaves are the same.
    some = made.rows.filter("doc_id % 10 = 4 or lang = 'fr'")
    whole = {(r.lang, r.doc_id, r.proof_sha256, r.folded_root) for r in proved}
    few = [(r.lang, r.doc_id, r.proof_sha256, r.folded_root) for r in merkle.prove(made, some).collect()]
    assert len(few) == some.count() and set(few) <= whole


def test_a_partition_fetches_only_what_it_lacks():
    rows = {"tree": np.zeros(20, "i8"), "pos": np.arange(8, 28), "n": np.full(20, 100)}
    import pyarrow as pa

    found = merkle._missing(1)((pa.scalar(3),), pa.table(rows)).to_pydict()
    # Places 28 to 31 beside the last leaf, node 0 and 4 to 7 of the next level, then the one other node.
    assert sorted(zip(found["level"], found["pos"])) == [(0, 28), (0, 29), (0, 30), (0, 31), (1, 0), (1, 4), (1, 5), (1, 6), (1, 7), (2, 1)]
    assert set(found["part"]) == {3}


def test_manifest_of_nothing_and_of_one(spark):
    none = built(spark, ROWS).rows.limit(0)
    made = merkle.manifest(none, "lang", ["doc_id"], keep=["tampered"])
    assert made.root is None and merkle.prove(made, made.rows).count() == 0
    with pytest.raises(ValueError, match="pos"):
        merkle.manifest(none, "lang", ["pos"])
    one = built(spark, ROWS[:1])
    row = merkle.prove(one, one.rows).first()
    assert one.root == row.leaf and row.proof_sha256 == digest("")


def test_fields_of_a_leaf(spark):
    table = spark.createDataFrame([(1, None, "é", "")], "a long, b string, c string, d string")
    assert table.select(merkle.leaf([F.col(c) for c in "abcd"])).first()[0] == digest("1:1-2:é0:")


# --- the pipeline's stages on odd rows ----------------------------------------------------------------

NAMES = "doc_id long, text string, lang string, source string, n_chars long, id int, row string, many int, key int, size int"


def rows_of(spark, rows):
    """Documents as files, as each stage reads them; with columns whose names the stages use inside."""
    from paceline.session import shared_path

    path = shared_path(spark, "odd")
    whole = [(i, t, "en", s, None if t is None else len(t), 1, extra, 3, 4, 5) for i, t, s, extra in rows]
    spark.createDataFrame(whole, NAMES).write.parquet(path)
    return spark.read.parquet(path)


COPY = "one two three four five six seven eight nine ten"
ODD_ROWS = [
    (1, COPY, "a", "x"), (1, COPY, "a", "y"), (3, COPY, "b", "x"), (3, "a text like nothing else that is here at all", "b", "x"),
    (None, COPY, "a", "x"), (None, "this text has no number of its own in here", "a", None), (7, None, "a", "x"), (8, "", None, "x"),
    (9, " \n", "a", "x"), (10, "lorem ipsum dolor " * 40_000, "b", "x"), (11, "short text", "a", "x"), (11, "short text", "a", "x"),
]


def test_near_copies_go_by_rows(spark):
    import corpus_pipeline

    docs = rows_of(spark, ODD_ROWS)
    found = corpus_pipeline.without_near_copies(prepare(spark), docs, SF)
    assert found.columns == docs.columns
    told = sorted((r.doc_id or 0, r.text or "") for r in found.collect())
    # Of the four copies one with id 1 stays; a row of id 3 that is like nothing else stays too.
    expected = [(1, COPY), (3, ODD_ROWS[3][1]), (0, ODD_ROWS[5][1]), (7, ""), (8, ""), (9, " \n"), (10, ODD_ROWS[9][1]), (11, "short text")]
    assert told == sorted(expected)
    assert corpus_pipeline.without_near_copies(spark, rows_of(spark, []), SF).count() == 0


def test_the_mix_keeps_columns_and_texts_without_words(spark):
    import corpus_pipeline

    docs = rows_of(spark, ODD_ROWS + [(20 + i, f"w{i} " * 50, "abc"[i % 3], str(i)) for i in range(60)])
    found = corpus_pipeline.mixed(prepare(spark), docs, SF)
    assert found.columns == docs.columns
    rows = [tuple(r) for r in found.collect()]
    there = {tuple(r) for r in docs.collect()}
    assert set(rows) <= there
    assert sorted(r[0] for r in rows if not (r[1] or "").strip()) == [7, 8, 9]
    # Rows that differ in one column only are rows of their own.
    assert {r[6] for r in rows if r[0] == 1} == {"x", "y"}
    again = [tuple(r) for r in corpus_pipeline.mixed(spark, docs, SF).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert corpus_pipeline.mixed(spark, rows_of(spark, []), SF).count() == 0


def test_all_stages_take_odd_rows(spark):
    import corpus_pipeline

    docs = rows_of(spark, ODD_ROWS)
    for _, stage in corpus_pipeline.STAGES:
        found = stage(prepare(spark), docs, SF)
        assert len(found.columns) == len(set(found.columns)) and found.count() <= 4 * len(ODD_ROWS)
        assert stage(spark, rows_of(spark, []), SF).count() == 0


def test_training_sees_whole_texts(spark):
    """Only the end of a long text in another script tells its label."""
    rows = [(i, "ж" * 2000 + ("да" if i % 2 else "нет") * 60) for i in range(120)]
    docs = spark.createDataFrame([(i, t, 9.0) for i, t in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    from paceline.llm import quality

    found = quality.score(docs, quality.learn(docs, labels))
    assert found.columns == ["doc_id", "text", "score"]
    scores = {r.doc_id: r.score for r in found.collect()}
    low, high = (np.mean([s for i, s in scores.items() if i % 2 == side]) for side in (0, 1))
    assert high > low + 0.02


# --- refusals and names of earlier operators ------------------------------------------------------------


def test_what_cannot_work_is_refused(spark):
    from public_tokenizers import PATTERN

    from paceline.llm import bpe, url_filters
    from paceline.llm.tables import fixed_rows

    pages = spark.createDataFrame([("http://x/",)], "url string")
    for host in ("", None):
        with pytest.raises(ValueError, match="host"):
            url_filters.judge(pages, fixed_rows(spark, ["host", "path", "action"], [("com", "/", "allow"), (host, "/x", "block")]))
    docs = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    with pytest.raises(ValueError, match="PATTERN"):
        bpe.encode(docs, {b"a": 0, b"b": 1}, r"\w+")
    ids = bpe.encode(docs, {b"a": 0, b"b": 1}, PATTERN).withColumn("decoded", F.lit("old"))
    found = bpe.decode(ids, {b"a": 0, b"b": 1})
    assert found.columns == ["doc_id", "ids", "decoded"] and bytes(found.first().decoded) == b"ab"
