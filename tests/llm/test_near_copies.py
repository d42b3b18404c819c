"""SimHash, embeddings, components and line windows against plain versions."""

from collections import Counter

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from specflow.llm import buckets, linededup, simhash, vectors
from specflow.llm.components import connected_components
from tests.compare import check, connect

SF = "/root/testdata/sf0.001"


def groups(n, links):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def plain_simhash(text):
    words = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(b" ".join(s), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def check_simhash(docs, **settings):
    rows = [(r.doc_id, plain_simhash(r.text)) for r in docs.select("doc_id", "text").collect()]
    known = sorted({d for d, _ in rows if d is not None})
    place = {d: i for i, d in enumerate(known)}
    real = [(place[d], fp) for d, fp in rows if d is not None]  # places repeat with their doc_id, which links them
    links = [(a, b) for a, x in real for b, y in real if (x ^ y).bit_count() <= 3]
    # a row without doc_id takes the component of its fingerprint
    root = groups(len(known), links)
    by_print = {}
    for i, fp in real:
        by_print[fp] = known[root[i]]
    want = Counter((d, f"{fp:016x}", by_print.get(fp) if d is None else known[root[place[d]]]) for d, fp in rows)
    got = Counter(tuple(r) for r in simhash.near_duplicates(docs, **settings).collect())
    assert got == want


def test_simhash(spark, odd_documents, no_documents):
    check_simhash(odd_documents)
    check_simhash(no_documents)
    check_simhash(spark.read.parquet(f"{SF}/documents.parquet"))


A = "one text of some length about a certain thing that stays as it is"
B = "quite another sentence that has nothing at all in common with the first"


def repeated(spark):
    rows = [(0, A), (1, A), (1, B), (2, B), (5, None), (5, A), (7, "words only here and nowhere else")]
    names = ["__at", "__x", "__doc", "__tie", "__gone", "__d", "__t", "__AT"]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *[f"{k} AS `{n}`" for k, n in enumerate(names[:-1])])


def test_repeated_ids_are_one_document(spark):
    check_simhash(repeated(spark))
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(repeated(spark)).collect()}
    assert found == {(0, 0), (1, 0), (2, 0), (5, 0), (7, 7)}


def test_keep_first_keeps_a_row_of_every_group(spark):
    docs = repeated(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    # text B stays once, with the smallest doc_id that has it
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(0, A), (1, B), (5, ""), (7, "words only here and nowhere else")]


def test_lines_with_awkward_column_names(spark):
    docs = repeated(spark)
    cut = linededup.drop_repeated_windows(docs, counts=True)
    assert cut.columns == [*docs.columns, "n_lines", "n_removed"]
    assert sorted(map(repr, cut.select(*docs.columns).collect())) == sorted(map(repr, docs.collect()))


def test_repeated_vec_ids_share_a_component(spark):
    chance = np.random.default_rng(8)
    x, y, z = (v.tolist() for v in chance.normal(size=(3, 16)))
    rows = [(0, x), (1, x), (1, y), (2, y), (3, z), (4, None), (4, z), (9, [0.0] * 16)]
    got = {(r.vec_id, r.component_id, r.n_links) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {(0, 0, 1), (1, 0, 1), (2, 0, 1), (3, 3, 1), (4, 3, 1), (4, 4, 0), (9, 9, 0)}


def test_simhash_agrees_with_the_engine_hash(spark):
    row = spark.sql("SELECT xxhash64('a b c') AS h").collect()[0]
    assert row.h % 2**64 == xxhash.xxh64(b"a b c", seed=42).intdigest()


def test_simhash_of_long_texts_in_portions(monkeypatch):
    texts = [" ".join(f"w{(i * k) % 97}" for i in range(k)) for k in (1, 2, 3, 9, 10, 11, 100)]
    whole = [simhash.simhash(t) for t in texts]
    monkeypatch.setattr(simhash, "SHINGLES", 4)
    assert [simhash.simhash(t) for t in texts] == whole


def test_near_links_of_a_large_crowded_list(spark):
    # all fingerprints share their upper half, so they meet in four lists of all members
    chance = np.random.default_rng(3)
    prints = sorted({int(x) for x in chance.integers(0, 1 << 9, 300)} | {int(x) for x in chance.integers(0, 1 << 31, 300)})
    table = spark.createDataFrame([(i, fp) for i, fp in enumerate(prints)], "node long, fp long")
    links = [(r.a, r.b) for r in simhash.near_links(table, chunk=64).collect()]
    want = groups(len(prints), [(i, j) for i, x in enumerate(prints) for j, y in enumerate(prints) if (x ^ y).bit_count() <= 3])
    assert groups(len(prints), links) == want


def test_keep_first(odd_documents):
    kept = simhash.keep_first(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and ids[7] == 0 and ids[None] == 2 and ids[3] == 1 and ids[4] == 0


@settings(max_examples=25, deadline=None)
@given(edges=st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=14))
def test_components_of_small_graphs(spark, edges):
    table = spark.createDataFrame(edges, "x long, y long").coalesce(1)
    got = {r.node: r.component for r in connected_components(table, "x", "y").collect()}
    root = groups(13, edges)
    assert got == {n: root[n] for e in edges if e[0] != e[1] for n in e}


def test_components_of_a_long_path_and_nulls(spark):
    path = spark.range(400).selectExpr("id AS x", "id + 1 AS y").union(spark.sql("SELECT CAST(null AS long), 7L"))
    got = connected_components(path, "x", "y")
    assert got.count() == 401 and got.where("component != 0").count() == 0


def check_vectors(table, **settings):
    rows = [(r.vec_id, r.embedding) for r in table.select("vec_id", "embedding").collect()]
    fine = [i for i, (v, e) in enumerate(rows) if v is not None and e and None not in e and np.isfinite(e).all() and any(e)]

    def near(i, j):
        a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
        return len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.95

    links = [(i, j) for i in fine for j in fine if i != j and near(i, j)]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    place = {i: k for k, i in enumerate(order)}
    root = groups(len(rows), [(place[i], place[j]) for i, j in links])
    count = Counter(i for i, _ in links)
    want = Counter()
    for i, (v, _) in enumerate(rows):
        component = rows[order[root[place[i]]]][0]
        want[v, count[i], component, component == v] += 1
    assert Counter(tuple(r) for r in vectors.near_vectors(table, **settings).collect()) == want


def test_vectors(spark):
    chance = np.random.default_rng(2)
    base = chance.normal(size=(12, 10))
    rows = [(i, (base[i % 12] + 0.2 * chance.normal(size=10)).tolist(), 0) for i in range(60)]
    rows += [(60, None, 1), (61, [0.0] * 10, 1), (62, [float("nan")] + [1.0] * 9, 1), (63, [None] + [1.0] * 9, 1), (64, [], 1)]
    rows += [(65, rows[3][1], 1), (66, rows[3][1], 2), (67, rows[3][1][:4], 1), (68, rows[3][1][:4], 1), (None, rows[3][1], 1)]
    rows += [(69, [1e300] * 10, 1), (70, [1e300] * 10, 1), (71, [-0.0, 1.0], 1), (72, [0.0, 1.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, bucket int")
    check_vectors(table.where("vec_id IS NULL OR vec_id NOT IN (69, 70)"), tables=12)
    check_vectors(table.where("vec_id < 40"), tables=12, chunk=8)
    check_vectors(table.where("vec_id < 40"), functions=3, tables=40)
    crowd = [(i, (base[0] + 0.05 * chance.normal(size=10)).tolist()) for i in range(150)]
    crowd = spark.createDataFrame(crowd, "vec_id long, embedding array<double>")
    check_vectors(crowd)  # one bucket of many, in one cell and in several
    check_vectors(crowd, chunk=60)
    huge = {r.vec_id: r for r in vectors.near_vectors(table).collect()}
    assert huge[69].n_links == huge[70].n_links >= 1 and huge[70].component_id == huge[69].component_id
    assert vectors.near_vectors(table.where("false")).collect() == []


def test_vectors_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.collect()
    unit = np.array([r.embedding for r in rows], float)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    want = sum(int((unit[a : a + 1000] @ unit.T >= 0.95).sum()) for a in range(0, len(unit), 1000)) - len(unit)
    got = sum(r.n_links for r in vectors.near_vectors(table).collect())
    assert 0.999 * want <= got <= want


def test_hashes_grow_with_the_logarithm_of_the_table():
    assert [vectors.functions_for(n, 64) for n in (0, 10**4, 10**6, 10**9, 10**11, 10**14)] == [2, 2, 3, 4, 5, 5]
    unit = np.random.default_rng(3).normal(size=(1500, 64))
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    aside = np.random.default_rng(4).normal(size=unit.shape)
    aside -= (aside * unit).sum(axis=1, keepdims=True) * unit
    other = 0.95 * unit + np.sqrt(1 - 0.95**2) * aside / np.sqrt((aside * aside).sum(axis=1, keepdims=True))
    for functions, tables in vectors.TABLES.items():
        x, y = (vectors.bucket_keys(v, functions, tables) for v in (unit, other))
        assert (x[:, :, :, None] == y[:, :, None, :]).any(axis=(1, 2, 3)).mean() > 0.998


def test_cells_cover_every_pair_once(spark):
    table = spark.range(50).selectExpr("id AS node", "id % 3 AS bucket").where("bucket < 2")

    def list_pairs(batches):
        import pyarrow as pa

        for starts, crossed, (node, side) in buckets.runs(batches, ["node", "side"]):
            node, side = node.to_numpy(), side.to_numpy(zero_copy_only=False)
            for a, b in buckets.pairs(starts, crossed, side, len(node), lambda a, b: np.ones(len(a), bool)):
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    for chunk in (1000, 5, 1):
        found = buckets.cells(table, "node", chunk=chunk).mapInArrow(list_pairs, "a long, b long").collect()
        got = Counter((min(r), max(r)) for r in map(tuple, found))
        assert got == Counter((a, b) for a in range(50) for b in range(a + 1, 50) if a % 3 == b % 3 < 2)


def plain_windows(rows):
    """rows of (doc_id, text) without repeats, in order -> remaining text."""
    seen, out = set(), {}
    for doc_id, text in rows:
        lines = text.split("\n") if text is not None else []
        gone = set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if any(line.strip() for line in window):
                if window in seen:
                    gone |= {i, i + 1, i + 2}
                seen.add(window)
        kept = [line for i, line in enumerate(lines) if i not in gone]
        out[doc_id] = None if text is None else "\n".join(kept)
    return out


def test_line_windows(spark, odd_documents, no_documents):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "a\nb\nc\na\nb\nc"), (4, "q\nq\nq\nq\nq"), (5, "a\nb"), (6, ""), (7, None),
            (8, "\n\n\n\n"), (9, "\n\n\n\n"), (10, "b\nc\nd\nnew"), (11, "a\nb\nc\nd")]
    table = spark.createDataFrame([(*r, "keep") for r in rows], "doc_id long, text string, __at string")
    got = linededup.drop_repeated_windows(table.select("doc_id", "text"))
    assert {r.doc_id: r.text for r in got.collect()} == plain_windows(rows)
    odd = linededup.drop_repeated_windows(odd_documents)
    assert odd.columns == odd_documents.columns and odd.count() == odd_documents.count()
    texts = Counter((r.doc_id, r.text) for r in odd.collect())
    assert texts[2, "start of it\nend of it"] == 1 and texts[7, ""] == 2 and texts[None, None] == 1 and texts[3, None] == 1
    assert linededup.drop_repeated_windows(no_documents, counts=True).collect() == []


def test_line_windows_stay_native(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    result = linededup.drop_repeated_windows(docs, counts=True)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_line_windows_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert check(linededup.drop_repeated_windows(docs, counts=True), connect("/root/testdata/sf0.01"), linededup.ORACLE) is None
