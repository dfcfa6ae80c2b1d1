"""Line dedup, near-dedup, decontamination, neighbours and the pipeline."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import differences, tables_of
from plumbline.llm import ann, components, decontam, langid, linededup, simhash
from plumbline.llm.registry import ORACLES
from plumbline.llm.sample import least_hashed
from plumbline.session import shared_folder

SF_DIR = "/root/testdata/sf0.001"


def test_lines_of_edges(spark, edges, nothing, as_table):
    kept = linededup.drop_repeated_lines(edges)
    assert kept.columns == [*edges.columns, "n_lines", "n_dropped"]
    rows = {r.doc_id: r for r in kept.collect()}
    assert (rows[5].text, rows[6].text) == ("own words of five", "own words of six")
    assert rows[7].n_dropped == 0 and rows[None].text == "no id"
    assert (rows[1].text, rows[1].n_lines, rows[2].n_lines, rows[3].n_lines) == ("", 1, 1, 2)
    assert kept.count() == 13 and linededup.drop_repeated_lines(nothing).count() == 0
    # SQL groups by doc_id: without the rows that share one or lack one.
    unique = edges.filter("doc_id is not null").dropDuplicates(["doc_id"])
    folder = as_table(unique)
    assert differences(linededup.op5(spark, folder), tables_of(folder), ORACLES["op5_line_dedup_runs"]) is None


def test_runs_are_merged_by_level(spark):
    runs = linededup.LineRuns(spark, f"{shared_folder(spark)}/runs-test", fanout=2)
    fresh = []
    for k in range(5):
        rows = [(10 * k + i, f"a line that all batches hold {j}") for i in range(2) for j in (0, k)]
        batch = spark.createDataFrame(rows, "doc_id bigint, text string")
        fresh.append(linededup.fresh_lines(runs, batch).count())
    assert fresh == [1, 1, 1, 1, 1]
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    totals = {(r.documents, r.last) for r in runs.totals().collect()}
    assert totals == {(10, 41), (2, 11), (2, 21), (2, 31), (2, 41)}


def components_of(bits, reach=2):
    parent = list(range(len(bits)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(bits)):
        for j in np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= reach) + i + 1:
            parent[root(int(j))] = root(i)
    return [root(i) for i in range(len(bits))]


def test_near_copies_against_brute_force(spark, texts):
    rows = simhash.op6(spark, SF_DIR).collect()
    bits = np.array([int(r.fingerprint, 16) for r in rows], dtype=np.uint64)
    smallest = {}
    group = components_of(bits)
    for g, r in zip(group, rows):
        smallest[g] = min(smallest.get(g, r.doc_id), r.doc_id)
    assert [r.component_id for r in rows] == [smallest[g] for g in group]
    for r in rows[:40]:
        assert int(r.fingerprint, 16) == plain_fingerprint(texts[r.doc_id])


def plain_fingerprint(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_links_of_fingerprints(spark):
    """All values within some bits of two centres, where cells are full."""
    rng = np.random.RandomState(2)
    bits = {0, (1 << 64) - 1}
    for centre in (0, int(rng.randint(1 << 62)), (1 << 64) - 1):
        for _ in range(150):
            flips = rng.choice(64, rng.randint(0, 6), replace=False)
            bits.add(centre ^ sum(1 << int(b) for b in flips))
    values = np.array(sorted(bits), dtype=np.uint64)
    signed = values.view(np.int64).tolist()
    rows = spark.createDataFrame([(b, k) for k, b in enumerate(signed)], "bits bigint, node bigint")
    found = dict(tuple(r) for r in components.components(simhash.links(rows)).collect())
    group = components_of(values)
    least = {}
    for k, g in enumerate(group):
        least.setdefault(g, k)
    assert [found.get(k, k) for k in range(len(group))] == [least[g] for g in group]


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 400), (400, 500), (7, 7)]
    found = dict(tuple(r) for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {**{k: 0 for k in range(201)}, 400: 400, 500: 400}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_copies_of_edges(edges, nothing):
    rows = simhash.near_copies(edges).collect()
    assert len(rows) == 13
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}
    kept = simhash.one_of_each_group(edges)
    assert kept.columns == edges.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    # 5 and 7 share 8 of 10 shingles; 6 holds the line twice, and the row without an id shares 6 of 10.
    assert {5, 6, 7}.intersection(ids) == {5, 6} and None in ids
    assert 2 not in ids and 1 in ids
    assert simhash.near_copies(nothing).count() == 0 and simhash.one_of_each_group(nothing).count() == 0


def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_one_of_each_group_against_brute_force(spark):
    """Edited copies at all distances, among texts of which many hold one passage."""
    import random

    draw = random.Random(8)

    def words(n):
        return [f"w{draw.randrange(10**6)}" for _ in range(n)]

    passage = words(120)
    rows = []
    for k in range(60):
        text = words(draw.randint(40, 400))
        if k % 2:
            text = words(draw.randint(10, 40)) + passage + words(draw.randint(10, 40))
        rows.append(" ".join(text))
        for _ in range(draw.randint(1, 4)):
            edited = list(text)
            for _ in range(draw.randint(0, max(1, len(text) // 25))):
                edited[draw.randrange(len(edited))] = f"e{draw.randrange(10**6)}"
            rows.append(" ".join(edited).upper() + " \n")
    rows += [None, "", " ", "one two", "One  two", "one two three"]
    sets = [shingle_set(text or "") for text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 10 * len(a & b) >= 8 * len(a | b):
                links += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    order = list(range(len(rows)))
    draw.shuffle(order)
    docs = spark.createDataFrame([(k, rows[k]) for k in order], "doc_id bigint, text string")
    kept = sorted(r.doc_id for r in simhash.one_of_each_group(docs).collect())
    assert links > 100 and kept == [k for k in range(len(rows)) if root(k) == k]


def test_slices_of_a_benchmark_give_the_same(spark, documents):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0]
    whole = decontam.contamination(documents, benchmark)
    cut = decontam.contamination(documents, benchmark, slice_bytes=size // 3 + 1).select(*whole.columns)
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))


def test_matches_are_the_longest_whatever_the_slices(spark):
    """Items that overlap in a text, copies of items, and matches inside of others; by plain loops."""
    rng = np.random.RandomState(8)
    words = [f"w{k}" for k in range(9)]
    texts = [" ".join(rng.choice(words, 120)) for _ in range(12)]
    items = []
    for k in range(60):
        own = texts[rng.randint(12)].split()
        a, n = rng.randint(0, 80), rng.randint(3, 40)
        items.append((k // 2, " ".join(own[a : a + n])))
        items.append((None if k % 9 == 0 else 100 + k, items[rng.randint(len(items))][1]))
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    expected = {}
    for doc_id, text in enumerate(texts):
        own, best = text.split(), {}
        for item_id, item in items:
            item = item.split()
            window = min(13, len(item))
            for p in range(len(own)):
                for j in range(len(item) - window + 1):
                    n = 0
                    while p + n < len(own) and j + n < len(item) and own[p + n] == item[j + n]:
                        n += 1
                    if n >= window:
                        rank = (-n, item_id is not None, item_id or 0, j)
                        best[p] = min(best.get(p, rank), rank)
        listed, furthest = [], 0
        for p, (n, there, item_id, j) in sorted(best.items()):
            if p - n > furthest:
                furthest = p - n
                listed.append((p, -n, item_id if there else None, j))
        expected[doc_id] = listed
    assert max(map(len, expected.values())) > 3
    for slice_bytes in (1 << 20, 400):
        found = decontam.contamination(documents, benchmark, slice_bytes=slice_bytes).collect()
        assert {r.doc_id: [tuple(m) for m in r.matches] for r in found} == expected


def test_contamination_of_edges(spark, edges, nothing, as_table):
    words = "the cat sat on the mat and looked at the moon over the quiet harbour of the town"
    items = [(1, words), (2, "own words of seven"), (3, ""), (4, None), (None, "own words of five"), (5, words), (6, "the the " * 40)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = {r.doc_id: r for r in decontam.contamination(edges, benchmark).collect()}
    assert rows[4].contaminated and rows[4].n_hit == rows[4].n_words and rows[4].items == [1, 5]
    assert rows[7].items == [2] and rows[7].matches[0].asDict() == {"start": 9, "length": 4, "item_id": 2, "item_start": 0}
    assert rows[5].n_hit == 4 and rows[5].items == []
    assert not rows[1].contaminated and rows[1].n_words == 0
    kept = decontam.without_contaminated(edges, benchmark)
    assert kept.columns == edges.columns and kept.filter("doc_id in (4, 5, 7)").isEmpty()
    assert decontam.contamination(nothing, benchmark).count() == 0
    assert decontam.without_contaminated(edges, benchmark.limit(0)).count() == 13
    unique = edges.filter("doc_id is not null").dropDuplicates(["doc_id"])
    folder = as_table(unique, benchmark=benchmark.filter("item_id is not null"))
    sql = ORACLES["op4_decontaminate_suffix_arrays"]
    assert differences(decontam.op4(spark, folder), tables_of(folder), sql) is None


def test_suffix_arrays_are_in_order():
    words = np.append(np.random.RandomState(0).randint(1, 4, 300), 0)
    words[[50, 51, 200]] = 0
    array = decontam.suffix_array(words, 13)

    def suffix(p):
        end = p + int(np.flatnonzero(words[p:] == 0)[0])
        return tuple(words[p : min(end, p + 13)].tolist())

    assert sorted(array.tolist()) == np.flatnonzero(words).tolist()
    assert [suffix(p) for p in array] == sorted(suffix(p) for p in array)


def test_neighbours_against_brute_force(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    vectors = spark.read.parquet(path).select("vec_id", "embedding").toPandas()
    x = np.array([np.array(v, dtype="f8") for v in vectors.embedding])
    ids = vectors.vec_id.to_numpy()
    asked = np.flatnonzero(ids % 20 == 0)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    exact = {ids[q]: set(ids[np.lexsort((ids, -s))[:20]]) for q, s in zip(asked, scores)}
    # The production parameter takes in all of these; recall on more vectors is in the README.
    for candidates, least in ((ann.CANDIDATES, 1.0), (len(ids) // 2, 0.75)):
        few = ann.nearest(spark.read.parquet(path), candidates).toPandas()
        found = few.groupby("query_id").vec_id.apply(set)
        assert np.mean([len(found[q] & e) / 20 for q, e in exact.items()]) >= least
    assert (few.groupby("query_id")["rank"].apply(sorted).apply(lambda r: r == list(range(1, 21)))).all()


def test_recall_does_not_fall_with_the_number_of_vectors(spark):
    """100,000 random vectors, of which the ids of 100 are divisible by 20."""
    rng = np.random.RandomState(4)
    x = rng.normal(size=(100_000, 64))
    ids = np.arange(len(x)) * 20 + np.where(np.arange(len(x)) < 100, 0, 1)
    rows = pa.table({"vec_id": ids, "embedding": list(x)})
    scores = x[:100] @ x.T
    scores[np.arange(100), np.arange(100)] = -np.inf
    exact = [set(ids[np.argsort(-s)[:20]]) for s in scores]
    found = ann.nearest(spark.createDataFrame(rows)).toPandas().groupby("query_id").vec_id.apply(set)
    assert np.mean([len(found[q] & e) / 20 for q, e in zip(ids, exact)]) >= 0.9


def test_samples_are_the_least_hashes(spark, edges, nothing):
    rows = spark.range(5000).select((F.col("id") % 4000).alias("id"), F.lit("x").alias("__h"))
    hashes = rows.distinct().select("id", F.xxhash64("id", F.lit(3)).alias("h")).orderBy("h")
    expected = {r.id for r in hashes.limit(100).collect()}
    assert sorted(r.id for r in least_hashed(rows, ["id"], 100, seed=3).collect()) == sorted(expected)
    assert least_hashed(rows, ["id"], 9000).count() == 4000
    once = least_hashed(edges, ["doc_id", "text"], 50)
    assert once.columns == edges.columns and once.count() == 12
    assert least_hashed(nothing, ["doc_id"], 5).count() == 0


def test_neighbours_of_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.5], 1), (2, [0.4, 0.5], 1)]
    rows += [(3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [None, 1.0], 1)]
    rows += [(40, [0.0], 1), (60, [1.0, 1.0, 1.0], 1), (None, [1.0, 1.0], 1)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")
    found = sorted(tuple(r) for r in ann.nearest(vectors).collect())
    ids = {0: [1, 20, 2, 2], 20: [0, 1, 2, 2]}
    assert [r[:3] for r in found] == [(q, k + 1, v) for q in (0, 20) for k, v in enumerate(ids[q])]
    assert [r[3] for r in found[:4]] == pytest.approx([1.0, 1.0, 0.5, 0.4])
    # Rows that share the id of a query are no rows of its own.
    shared = spark.createDataFrame([(20, [0.9, 0.0]), (20, [0.1, 0.0]), (1, [0.5, 0.0])], "vec_id bigint, embedding array<double>")
    found = sorted((r.query_id, r["rank"], round(r.score, 2), r.vec_id) for r in ann.nearest(shared).collect())
    assert found == [(20, 1, 0.09, 20), (20, 1, 0.45, 1), (20, 2, 0.05, 1), (20, 2, 0.09, 20)]
    assert ann.nearest(vectors.limit(0)).count() == 0


def test_stages_pick_rows_and_not_ids(spark):
    """Rows that share an id, or lack one, stay or go each by its own text."""
    import random

    draw = random.Random(3)
    x, y, z = (" ".join(str(draw.randrange(10**9)) for _ in range(80)) for _ in range(3))
    rows = [(3, y), (5, x), (5, y), (None, z), (None, x + " " + z), (None, y), (6, z)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted((r.text, r.doc_id or 0) for r in simhash.one_of_each_group(docs).collect())
    assert kept == sorted([(y, 3), (x, 5), (z, 6), (x + " " + z, 0)])
    benchmark = spark.createDataFrame([(1, y)], "item_id bigint, text string")
    left = decontam.without_contaminated(docs, benchmark).collect()
    assert sorted(r.text for r in left) == sorted([x, z, x + " " + z, z])

    english = "the cat sat on the mat and looked at the moon over the quiet harbour of the town. " * 20
    mixed = [(k, english, "en") for k in range(1, 40)] + [(None, english, "en"), (None, "123 ---", "en")]
    mixed = spark.createDataFrame([*mixed, (2, "456 !!!", "en")], "doc_id bigint, text string, lang string")
    found = langid.recognized(mixed).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in found} == {None: 1, **{k: 1 for k in range(1, 40)}}


def test_pipeline_of_edges(spark, edges, as_table):
    benchmark = spark.createDataFrame([(1, "le chat noir est assis sur la chaise près de la fenêtre")], "item_id bigint, text string")
    folder = as_table(edges, benchmark=benchmark)
    docs = edges
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, folder)
        assert docs.columns == edges.columns, name
        assert docs.count() <= before.count()
    left = {r.doc_id for r in docs.select("doc_id").collect()}
    assert left.isdisjoint({1, 2, 3, 8, 9}) and {4, 5, 7} <= left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == left


def test_pipeline_keeps_what_each_stage_keeps(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).toArrow())
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert sum(r.length for r in rows if r.start == 0) > 0
