"""The operators against plain definitions on small odd documents."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from arealis.llm import near_dedup, suffix_dedup
from arealis.llm.exact_dedup import exact_duplicates, merge_filters, pack_filter, unpack_filter
from arealis.llm.licenses import KNOWN, license_scan
from arealis.llm.mixing import mixed
from arealis.llm.near_dedup import near_duplicates
from arealis.llm.packing import packed, plan
from arealis.llm.quality import quality_scores
from arealis.llm.suffix_dedup import repeated_bytes, repeated_spans, repeated_starts, without_repeats
from arealis.llm.token_files import read_file, read_sequence, token_documents, write_token_files
from arealis.llm.tokens import default_vocabulary, encoded
from arealis.llm.toxicity import fit_nnpu, toxicity_scores
from arealis.llm.vector_search import nearest, nearest_of_step
from tests.llm.helpers import WORD, frame, odd_documents, sentence, shingles, similar_groups


@pytest.fixture(scope="module")
def rows():
    return odd_documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def labels(spark, rows):
    known = [(i, i % 3 != 0, i % 4 == 0) for i, _, _ in rows if i is not None]
    return spark.createDataFrame(
        [(i, int(q), int(t)) for i, q, t in known] + [(None, 1, 1), (5, None, None)],
        "doc_id long, quality int, toxic int",
    )


def test_near_duplicates_are_the_components_of_similar_pairs(rows, docs):
    expected = similar_groups(rows)
    found = near_duplicates(docs).collect()
    assert len(found) == len(rows)
    texts = defaultdict(list)
    for i, t, _ in rows:
        texts[i].append(len(shingles(t)))
    for r in found:
        assert r.n_shingles in texts[r.doc_id]
        if r.doc_id not in (7, None):  # 7 names two texts
            assert r.component_id == expected[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_of_edited_copies_lose_no_link(spark):
    rng = random.Random(2)
    words = sentence(rng, 150).split()
    rows = []
    for i in range(150):
        edited = list(words)
        for _ in range(rng.choice((1, 1, 2, 3, 3, 4))):
            edited[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(edited), "a"))
        if i % 10 == 0:  # an edit on top of an edit: linked to its parent at most
            edited[rng.randrange(150)] = "again"
            rows.append((1000 + i, " ".join(edited), "a"))
    expected = similar_groups(rows)
    found = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows)).collect()}
    assert found == expected
    assert len(set(found.values())) > 1


def test_circulant_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(1)
    both, one, other = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    a, b = np.append(both, one), np.append(both, other)
    x, y = near_dedup.circulant_signatures([a, b], 512)
    assert abs((x == y).mean() - 0.6) < 0.08


def test_exact_duplicates(rows, docs):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    found = exact_duplicates(docs).collect()
    assert len(found) == len(rows)
    digests = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    for r in found:
        ids = groups[digests[r.text_sha256]]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        assert r.kept == (r.doc_id == r.keep_id)


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(3)
    total = Counter()
    filters = []
    for n in (1, 7, 5000):
        tails = rng.integers(0, 1 << 40, n).astype(np.uint64)
        tails[: n // 2] = tails[0]
        found, counts = np.unique(tails, return_counts=True)
        packed_filter = pack_filter(found, counts)
        again = unpack_filter(packed_filter)
        assert np.array_equal(again[0], found) and np.array_equal(again[1], counts)
        filters.append(packed_filter)
        total.update(dict(zip(found.tolist(), counts.tolist(), strict=True)))
    found, counts = merge_filters(filters)
    assert dict(zip(found.tolist(), counts.tolist(), strict=True)) == total


def test_tokens_are_those_of_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_vocabulary())
    rng = random.Random(4)
    parts = [*"ab é中  \n\t\r'!.1<|> 　", "<|endoftext|>", " a", "'s", " the"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["", "x" * 5000, " ".join(f"w{i}" for i in range(3000))]
    got = list(encoded(default_vocabulary(), [t.encode() for t in texts]))
    expected = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in got] == expected


def token_lists(rows, end):
    texts = [(t or "").encode() for _, t, _ in rows]
    return [np.append(x, end).astype("<u4") for x in encoded(default_vocabulary(), texts)]


def test_token_files(rows, docs):
    held = sorted(
        (
            (-1 if i is None else i, t or "", ids)
            for (i, t, _), ids in zip(rows, token_lists(rows, 0), strict=True)
        ),
        key=lambda x: x[:2],
    )
    expected, at = [], 0
    for i, _, ids in held:
        expected.append((None if i < 0 else i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    found = token_documents(docs, length=64, file_tokens=1000).collect()
    order = lambda x: (x[1], x[2])
    assert sorted(map(tuple, found), key=order) == sorted(expected, key=order)


def test_token_sequences_are_found_by_position(spark, docs, tmp_path):
    files = write_token_files(docs, str(tmp_path), length=32, file_tokens=500).collect()
    assert len(files) > 1
    for f in files:
        names, docs_read = read_file(f.path)
        stream = np.concatenate(docs_read)
        assert len(stream) == f.tokens and len(names) == len(docs_read)
        for k in (0, (f.tokens - 1) // 32):
            ids, mask = read_sequence(f.path, k)
            whole = stream[32 * k : 32 * k + 32]
            assert ids.to_numpy()[: len(whole)].tolist() == whole.tolist()
            assert mask.to_pylist() == [j < len(whole) for j in range(32)]


def test_licenses_by_canonical_text(spark):
    mit = dict(reversed(KNOWN))["ISC"]
    rows = [
        (1, mit, None),
        (2, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(",", " ;"), None),
        (3, mit + " and more", None),
        (4, "prose\nRELEASED under the   MIT licence\nprose", None),
        (5, "Released under the MIT License.", None),
        (6, None, None),
        (7, "the licence licence of", None),
    ]
    found = {r.doc_id: r for r in license_scan(frame(spark, [*rows, rows[3]])).collect()}
    assert [found[i].license for i in range(1, 8)] == ["ISC", "ISC", None, None, "MIT", None, None]
    assert found[4].notices == "MIT" and found[5].n_notices == 1 and found[6].n_notices == 0


def test_quality_rules_find_junk(spark):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(900):
        text = sentence(rng, 60)
        if i % 3 == 0:
            text = " ".join(w + "###" for w in text.split()) if i % 2 else text.upper().replace(" ", " | ")
        rows.append((i, text, "a"))
        marks.append((i, int(i % 3 != 0), 0))
    data = frame(spark, [*rows, (None, None, None)])
    known = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = [r for r in quality_scores(data, known).collect() if r.doc_id is not None and r.held_out]
    right = sum(r.predicted == (r.doc_id % 3 != 0) for r in found)
    assert len(found) > 150 and right / len(found) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def plain_repeats(rows, size):
    texts = [(t or "").encode() for _, t, _ in rows]
    counts = Counter(x[i : i + size] for x in texts for i in range(len(x) - size + 1))
    out = []
    for (name, _, _), x in zip(rows, texts, strict=True):
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - size + 1):
            if counts[x[i : i + size]] > 1:
                gone[i : i + size] = True
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = bytes(np.frombuffer(x, np.uint8)[~gone])
        out.append((name, len(x), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [2_000, 1])
def test_repeated_bytes(rows, docs, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    found = [tuple(r) for r in repeated_bytes(docs).collect()]
    assert Counter(found) == Counter(plain_repeats(rows, 200))
    assert any(r[2] and r[2] < r[1] for r in found)


@pytest.mark.parametrize("crowd", [3, 12])
def test_a_common_passage_is_counted_in_pieces(spark, monkeypatch, crowd):
    """Every text has the passage between bytes of its own, some of which a second text shares."""
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    rng = random.Random(crowd)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage, shared = letters(300), [(letters(90), letters(90)) for _ in range(6)]
    texts = [letters(rng.randrange(400)) + passage[rng.randrange(60) :] + letters(rng.randrange(400)) for _ in range(40)]
    for before, after in shared:
        texts += [letters(50) + before + passage[40:200] + after + letters(50) for _ in range(2)]
        texts += [letters(150) + passage[:150] + after, before + passage[-150:] + letters(150)]
    rows = [(i % 50, t, "") for i, t in enumerate(texts)]
    docs = frame(spark, rows)
    assert Counter(tuple(r) for r in repeated_bytes(docs).collect()) == Counter(plain_repeats(rows, 200))
    spans = repeated_spans(docs)
    # runs, not strings
    assert spans.count() < 12 * len(texts)


def test_kept_bytes_are_returned(docs):
    for r in without_repeats(docs).collect():
        assert len(r.kept_bytes) == r.n_bytes - r.n_removed
        assert hashlib.sha256(r.kept_bytes).hexdigest() == r.kept_sha256


def test_suffix_bucket_with_the_difference_cover():
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choice("ab") for _ in range(n))
    base = letters(500)
    for _ in range(20):
        texts = [
            letters(rng.randrange(40)) + base[(a := rng.randrange(250)) : a + 230] + letters(rng.randrange(9))
            for _ in range(5)
        ]
        data = "".join(texts).encode()
        ends = np.cumsum([len(t) for t in texts])
        starts = np.concatenate(
            [np.arange(e - len(t), e - 199) for e, t in zip(ends, texts, strict=True)]
        )
        counts = Counter(data[i : i + 200] for i in starts)
        expected = [counts[data[i : i + 200]] > 1 for i in starts]
        assert repeated_starts(np.frombuffer(data, np.uint8), starts).tolist() == expected


@pytest.mark.parametrize("n", [0, 1, 40, 20_000])
def test_packing_plan_places_every_piece_once(n):
    rng = np.random.default_rng(n)
    counts = Counter(rng.integers(1, 1025, n).tolist())
    places, sequences = plan(dict(counts), 1024)
    seen, held = Counter(), defaultdict(list)
    for length, a, b, first, offset in places:
        seen[length] += b - a
        for k in range(b - a):
            held[first + k].append((offset, length))
    assert seen == counts and len(held) == sequences
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(k * c for k, c in counts.items())
    assert sequences <= max(1, total / 1024 * (1.01 if n > 1000 else 1.6)) or not n


def test_packed_documents(rows, docs):
    found = packed(docs).collect()
    lists = Counter()
    for (i, _, _), ids in zip(rows, token_lists(rows, 2), strict=True):
        first = len(ids) % 1024 or 1024
        edges = [0, len(ids)] if len(ids) <= 1024 else [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            lists[(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == lists
    held = defaultdict(list)
    for r in found:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024


def test_mix_reaches_its_targets(rows, docs):
    found = mixed(docs).collect()
    assert len(found) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    assert sum(sizes.values()) == sum(len(WORD.findall(t or "")) for _, t, _ in rows)
    left, free = Fraction(3, 2) * sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(free)}
    want = {}
    while True:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > 2 * sizes[s]]
        if not over:
            break
        for s in over:
            want[s] = 2 * sizes[s]
            left -= want[s]
            free.remove(s)
    want |= {s: weight[s] * level for s in free}
    largest = max(r.size for r in found)
    for s, t in want.items():
        assert abs(target[s] - float(t)) < 1e-6
        assert abs(taken[s] - t) <= largest / 2
    assert {tuple(r) for r in found} == {tuple(r) for r in mixed(docs).collect()}


def test_positive_unlabelled_risk_learns_hidden_positives():
    rng = np.random.default_rng(5)
    features = [np.flatnonzero(rng.random(30) < 0.2) for _ in range(3000)]
    truth = np.array([3 in f or 7 in f for f in features])
    positive = truth & (rng.random(3000) < 0.5)
    rows = [f for f, p in zip(features, positive, strict=True) if p] + features
    marks = np.append(np.ones(positive.sum(), bool), np.zeros(3000, bool))
    weights, bias = fit_nnpu(rows, marks, 30, truth.mean())
    scores = np.array([bias + weights[f].sum() for f in features]) > 0
    assert (scores == truth).mean() > 0.97


def test_toxic_documents(spark):
    rng = random.Random(9)
    rows, marks = [], []
    for i in range(1200):
        words = sentence(rng, 50).split()
        if i % 8 == 0:
            words[rng.randrange(50)] = rng.choice(["vilest", "vilely", "Grimy."])
            words[rng.randrange(50)] = rng.choice(["vilesse", "grimy!"])
        rows.append((i, " ".join(words), "a"))
        if i % 2 == 0:
            marks.append((i, 1, int(i % 8 == 0)))
    data = frame(spark, [*rows, (None, None, None)])
    known = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = [r for r in toxicity_scores(data, known).collect() if r.doc_id is not None and r.held_out]
    right = sum(r.predicted == (r.doc_id % 8 == 0) for r in found)
    assert len(found) > 200 and right / len(found) > 0.97


def vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist(), 0) for i in range(700)]
    rows += [(i, rows[5][1], 0) for i in range(700, 760)]  # ties
    rows += [rows[3], (None, rows[1][1], 0), (800, None, 0), (900, [0.0] * 8, 0)]
    rows += [(801, [None, *[1.0] * 7], 0), (802, [float("nan"), *[1.0] * 7], 0), (1000, [float("inf")] * 8, 0)]
    rows += [(803, [1.0, 2.0], 0), (1100, [1.5, 2.0], 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int"), rows


def plain_nearest(rows, k=10):
    good = {}
    for i, v, _ in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    out = {}
    for i, v in good.items():
        if i % 100 == 0:
            d = [
                (float(np.sqrt(np.cumsum((v - w) ** 2)[-1])), j)
                for j, w in good.items()
                if j != i and len(w) == len(v)
            ]
            out[i] = sorted(d)[:k]
    return out


def test_nearest_vectors_are_exact_with_factor_one(spark):
    df, rows = vectors(spark)
    found = defaultdict(list)
    for r in nearest_of_step(df, shard_size=150, block_size=3).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(found[r.query_id])
    assert found == plain_nearest(rows)


def test_relaxed_search_finds_most(spark):
    df, rows = vectors(spark)
    expected = plain_nearest(rows)
    asked = df.where("vec_id % 100 = 0")
    found = {(r.query_id, r.vec_id) for r in nearest(df, asked, relax=1.3, shard_size=300).collect()}
    pairs = {(q, v) for q, hits in expected.items() for _, v in hits}
    assert len(found & pairs) >= 0.9 * len(pairs)


def test_empty_tables(spark, empty, labels):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    unlabelled = labels.where("false")
    for found in (
        near_duplicates(empty),
        exact_duplicates(empty),
        token_documents(empty),
        license_scan(empty),
        quality_scores(empty, labels),
        quality_scores(empty, unlabelled),
        repeated_bytes(empty),
        packed(empty),
        mixed(empty),
        toxicity_scores(empty, labels),
        toxicity_scores(empty, unlabelled),
        nearest_of_step(none),
    ):
        assert found.count() == 0


def test_scores_of_odd_documents(rows, docs, labels):
    for found in (quality_scores(docs, labels), toxicity_scores(docs, labels)):
        held = found.collect()
        assert len(held) == len(rows)
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in held)
    none = labels.where("false")
    assert {r.score for r in toxicity_scores(docs, none).collect()} == {0.0}
    assert {r.score for r in quality_scores(docs, none).collect()} == {0.5}
