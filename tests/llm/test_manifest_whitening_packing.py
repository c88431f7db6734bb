"""Merkle manifest, whitening and best-fit decreasing packing against
brute-force versions, with nulls, ties, repeated rows and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sluice.llm import best_fit, merkle, tokens, whitening
from sluice.llm.queries import QUERIES

CLASH = ["g", "id", "digest", "m", "rank", "block", "slot", "run", "word", "bits", "range", "row", "x", "v", "size",
         "entry", "value", "length", "task", "own_rank", "start", "n"]


def clashing(df):
    for c in CLASH:
        df = df.withColumn(c, F.lit(1))
    return df


# --- Merkle manifest --------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return sha("".join(map(part, row)))


def tree(nodes):
    """Root and the way of each node: (sibling or None, whether it stands left)."""
    ways, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, way in enumerate(ways):
            k = at[i] ^ 1
            way.append((level[k], k < at[i]) if k < len(level) else (None, False))
            at[i] //= 2
        level = [sha("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
    return level[0], ways


def brute_manifest(rows):
    """Rows (doc_id, source, lang, n_chars, text) to result rows, sorted."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    parts = []
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        parts.append((own, *tree([leaf(r) for r in own])))
    root, upper = tree([subroot for _, subroot, _ in parts])
    out = []
    for (own, subroot, ways), above in zip(parts, upper):
        for r, way in zip(own, ways):
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                node = leaf((*r[:3], r[3] + 1, r[4]))
            for s, left in way + above:
                node = sha((s or "") + node) if left else sha(node + (s or ""))
            out.append((r[0], leaf(r), subroot, root, sha("".join(s for s, _ in way + above if s)), node, node == root))
    return sorted(out, key=str)


def run_manifest(spark, path, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    clashing(df).repartition(5).write.parquet(f"{path}/documents.parquet")
    got = merkle.op11_bitmap_rank_manifest(spark, str(path), **how)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_manifest_with_repeated_null_and_odd_rows(spark, tmp_path):
    r = random.Random(3)
    rows = []
    for _ in range(700):
        lang = r.choice([None, "", "en", "en", "en", "é", "+", "zz"])
        doc_id = r.choice([None, -1, 7, 64, 65, 4096, 2 ** 62, -2 ** 63, *[r.randint(-9000, 9000) for _ in range(12)]])
        rows.append((doc_id, r.choice([None, "", "web"]), lang, r.choice([None, 0, 12]), r.choice([None, "", "naïve", "x" * 9])))
    rows += [(5, "s", "en", 1, "a copy")] * 30 + [(1, "s", "only", 3, "y" * 200_000)]
    assert run_manifest(spark, tmp_path, rows) == brute_manifest(rows)


def test_manifest_over_several_slot_arrays(spark, tmp_path):
    """Slot arrays of four levels: runs of equal rows over several arrays, a
    hot id, several rounds, and groups that end in the first round."""
    rows = [(i * 3, "s", "en" if i % 3 else "de", i % 5, f"t{i}") for i in range(900)]
    rows += [(100, "s", "en", 1, "same")] * 200 + [(100, "s", "en", i, "hot id") for i in range(150)]
    rows += [(None, "s", "en", i, None) for i in range(40)] + [(i, None, f"lang{i}", 1, "alone") for i in range(40)]
    rows += [(i, None, "sixteen", 1, "full") for i in range(16)]
    assert run_manifest(spark, tmp_path, rows, levels=4) == brute_manifest(rows)


def test_manifest_positions_and_paths(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, "t") for i in (9, 4, 70, 5000, -3)],
                                 "doc_id long, source string, lang string, n_chars long, text string")
    rows = merkle.manifest(docs).orderBy("position").collect()
    assert [r.id for r in rows] == [-3, 4, 9, 70, 5000] and [r.position for r in rows] == list(range(5))
    assert all(r.changed is None and len(r.sides) == 3 for r in rows)
    assert rows[4].sides == "001" and len(rows[4].siblings) == 1


def test_running_sum_over_ranges(spark, tmp_path):
    r = random.Random(1)
    rows = [(r.choice("aaab"), k, r.randint(1, 9)) for k in r.sample(range(10 ** 6), 3000)]
    spark.createDataFrame(rows, "g string, k long, w long").repartition(7).write.parquet(f"{tmp_path}/t")
    got = merkle.running_before(spark.read.parquet(f"{tmp_path}/t"), ["g"], ["k"], "w", "before").collect()
    total = Counter()
    want = {}
    for g, k, w in sorted(rows):
        want[g, k] = total[g]
        total[g] += w
    assert {(x.g, x.k): x.before for x in got} == want


# --- whitening --------------------------------------------------------------

def write_vectors(spark, path, rows, kind="float"):
    clashing(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")).repartition(4).write.parquet(
        f"{path}/embeddings.parquet")


def check_whitening(got, vectors, expected=None):
    """Against an eigendecomposition; ``vectors`` are (id, entries) of the rows that take part."""
    x = np.floor(64 * np.array([v for _, v in vectors], float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    away = n * x - sums
    c = away / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = expected or min(32, x.shape[1])
    rows = defaultdict(list)
    for r in got:
        rows[r.vec_id].append(r)
    assert Counter(i for i, _ in vectors for _ in range(k)) == Counter(r.vec_id for r in got)
    assert {r.component for r in got} == set(range(1, k + 1))
    want = c @ axes[:, :k] / np.sqrt(values[:k])
    signs = {}
    for i, (vec_id, _) in enumerate(vectors):
        for r in rows[vec_id]:
            assert r.n == n and r.identity_error < 1e-9
            assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
            w = want[i, r.component - 1]
            if len(rows[vec_id]) == k:          # ids that are not repeated
                assert r.deviation == int((away[i].astype(object) ** 2).sum())
                if abs(w) > 1e-3:
                    sign = signs.setdefault(r.component, np.sign(w * r.whitened))
                    assert abs(sign * r.whitened - w) < 1e-6, (r, w)


def test_whitening_of_the_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    got = QUERIES["op12_shifted_cholesky_qr"](spark, SF_SMALL).collect()
    check_whitening(got, [(r.vec_id, r.embedding) for r in rows if r.embedding is not None])


def test_whitening_leaves_unusable_vectors_out(spark, tmp_path):
    rng = np.random.default_rng(5)
    good = [(i, (rng.normal(size=6) * [9, 5, 3, 2, 1, 0.5]).tolist()) for i in range(200)]
    nan, inf = float("nan"), float("inf")
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [nan] * 6), (904, [1.0] * 5 + [-inf]),
           (905, [1.0, 2.0]), (906, [1e300] * 6)]
    rows = good + [(3, good[3][1]), (None, good[4][1])]
    write_vectors(spark, tmp_path, rows + bad, "double")
    check_whitening(whitening.op12_shifted_cholesky_qr(spark, str(tmp_path)).collect(), rows)


@pytest.mark.parametrize("kind", ["dependent", "few"])
def test_whitening_of_dependent_dimensions(spark, tmp_path, kind):
    rng = np.random.default_rng(6)
    a = rng.normal(size=(80 if kind == "dependent" else 5, 4)) * 20
    # x is the entry itself here (multiples of 1/64), so sums of dimensions are dependent exactly.
    a = np.round(a * 64) / 64
    v = np.hstack([a, a[:, :1], a[:, 1:2] + a[:, 2:3], np.full((len(a), 1), 3.0)] + ([a * 2] if kind == "few" else []))
    rows = list(enumerate(v.tolist()))
    write_vectors(spark, tmp_path, rows, "double")
    check_whitening(whitening.op12_shifted_cholesky_qr(spark, str(tmp_path)).collect(), rows, 4)


def test_whitening_of_badly_scaled_dimensions(spark, tmp_path):
    """Deviations over eight orders of magnitude, as squares over sixteen."""
    rng = np.random.default_rng(7)
    rows = list(enumerate((rng.normal(size=(300, 5)) * 10.0 ** np.array([8, 6, 4, 2, 0])).tolist()))
    write_vectors(spark, tmp_path, rows, "double")
    got = whitening.op12_shifted_cholesky_qr(spark, str(tmp_path)).collect()
    assert {r.component for r in got} == {1, 2, 3, 4, 5} and max(r.identity_error for r in got) < 1e-6
    smallest = sorted({(r.component, r.explained) for r in got})[-1][1]
    assert 1e-17 < smallest < 1e-15
    assert any(r.deviation is None or r.deviation > 2 ** 62 for r in got)


@pytest.mark.parametrize("rows", [[(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, []), (2, None)]])
def test_whitening_without_variation(spark, tmp_path, rows):
    write_vectors(spark, tmp_path, rows)
    assert whitening.op12_shifted_cholesky_qr(spark, str(tmp_path)).collect() == []


def test_triangular_solve_and_shifted_factor():
    rng = np.random.default_rng(8)
    a = rng.normal(size=(50, 6))
    r = whitening.factor_of(a.T @ a, False)
    assert np.allclose(whitening.solve(a, r) @ r, a) and np.allclose(np.triu(r), r)
    q = whitening.solve(a, r)
    assert np.allclose(q.T @ q, np.eye(6))
    assert np.isfinite(whitening.factor_of(np.ones((4, 4)), False)).all()


# --- best-fit decreasing ----------------------------------------------------

def plain_rooms(histogram, size):
    """Rooms left by best fit piece by piece, longest first."""
    rooms = []
    for length in range(size, 0, -1):
        for _ in range(histogram[length]):
            fits = [i for i, room in enumerate(rooms) if room >= length]
            if fits:
                rooms[min(fits, key=rooms.__getitem__)] -= length
            else:
                rooms.append(size - length)
    return sorted(rooms)


def test_histogram_placement_is_best_fit_decreasing():
    r = random.Random(1)
    for _ in range(150):
        size = r.choice([1, 5, 8, 16, 33])
        histogram = [0] + [r.choice([0, 0, 1, 2, 5, 40]) for _ in range(size)]
        places, sequences = best_fit.best_fit_decreasing(histogram, size)
        held = defaultdict(list)
        for length, rows in places.items():
            for rank in range(histogram[length]):
                k = np.searchsorted(rows[:, 0], rank, side="right") - 1
                held[int(rows[k, 1]) + rank - int(rows[k, 0])].append((int(rows[k, 2]), length))
        left = []
        for pieces in held.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            left.append(size - at)
        assert sorted(left) == plain_rooms(histogram, size) and set(held) == set(range(sequences))


def test_rooms_give_the_tightest():
    r = random.Random(2)
    for largest in (1, 7, 8, 100):
        rooms, open_rooms = best_fit.Rooms(largest), set()
        for _ in range(300):
            room = r.randint(0, largest)
            rooms.set(room, room not in open_rooms)
            open_rooms ^= {room}
            need = r.randint(0, largest)
            assert rooms.tightest(need) == min((x for x in open_rooms if x >= need), default=None)


ODD = [None, "", " ", "one", "x " * 30000, "x" * 5000, "é𝄞<|endoftext|> naïve", "same", "same"]


def check_packing(rows, texts, max_len=2048, end_id=1):
    """``texts``: doc_id to text."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_file())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    histogram = [0] * (max_len + 1)
    for doc_id, text in texts.items():
        ids = t.encode(text or "", add_special_tokens=False).ids + [end_id]
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            own = np.array(ids[r.start:r.start + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(own.tobytes()))
            at += r.length
            assert r.length == max_len or at == len(ids)
            histogram[r.length] += 1
        assert at == len(ids)
    left = []
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        left.append(max_len - at)
    assert min(left) >= 0 and sorted(left) == plain_rooms(histogram, max_len)


def test_packing_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    check_packing(QUERIES["op13_best_fit_decreasing"](spark, SF_SMALL).collect(), {r.doc_id: r.text for r in docs})


def test_packing_of_odd_texts(spark, tmp_path):
    texts = dict(enumerate(ODD))
    clashing(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet")
    check_packing(best_fit.op13_best_fit_decreasing(spark, str(tmp_path)).collect(), texts)


def test_packing_of_a_hot_length(spark):
    docs = clashing(spark.createDataFrame([(i, "a b c" if i % 3 else "a " * (i % 40)) for i in range(600)],
                                          "doc_id long, text string")).repartition(6)
    rows = best_fit.packed(docs, max_len=32, end_id=0).select("row.doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                              "sequence_id", "offset").collect()
    check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, 32, 0)


def test_padding_spares_powers_of_two(spark):
    placed = spark.createDataFrame([(1, 5), (1, 3), (2, 7), (3, 16), (4, 1)], "sequence_id long, length long")
    assert {r.sequence_id: (r.tokens, r.padded) for r in best_fit.sequences(placed, 16).collect()} == {
        1: (8, 8), 2: (7, 16), 3: (16, 16), 4: (1, 1)}
