"""Operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns; queries against SQL or plain versions."""

import functools
import hashlib
import itertools
import os
import random
from html.parser import HTMLParser

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from mizan.llm import common, decontaminate, graph, html, jaccard, licences, neighbours, pieces, quality, toxicity, warc, wordpiece
from tests.conftest import SF

from .test_kernels import plain_scan, plain_shingles

PATH = public_tokenizers.path(pieces.MODEL)
LONG = "word another " * 20000
LARGER = SF.replace("0.001", "0.01")
DOCS = [(1, "a b c d e f g", "x"), (2, None, None), (3, "", "y"), (4, LONG, "x"), (1, "a b c d e f g", "x"), (None, "no id here", "z"), (5, " \n ", "x"), (6, "A B C D E F G", "q")]
SCHEMA = "doc_id bigint, text string, score string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_every_operator_is_registered():
    names = list(__spark_entry__.queries())
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)] == [] and "pipeline" in names


def test_text_operators_on_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 1), (None, 1), (9, None)], "doc_id bigint, label int")
    w, model = quality.fit(docs, labels), toxicity.fit(docs, labels)
    for df, n in ((docs, len(DOCS)), (empty, 0)):
        assert pieces.encoded(df, PATH, with_ids=True).count() == n
        assert wordpiece.counted(df, PATH).count() == n
        assert quality.scored(df, w).where("score between 0 and 1").count() == n
        assert toxicity.scored(df, model).where("score between 0 and 1").count() == n
        assert licences.scanned(df).count() == n
        assert jaccard.joined(df).count() == n
    assert quality.fit(empty, labels).any() == False  # noqa: E712
    assert toxicity.fit(empty, labels).toxic is not None


def test_clashing_names(spark, docs):
    """A kept column may have any name but those an operator makes; within it no name can clash."""
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id bigint, label int")
    w, model = quality.fit(docs, labels), toxicity.fit(docs, labels)
    odd = docs.select("doc_id", "text", *(F.lit(x).alias(x) for x in ("row", "host", "paths", "node", "root", "component", "salt", "html", "url")))
    operators = {
        "n_tokens": lambda d, k: pieces.encoded(d, PATH, k),
        "N_WORDS": lambda d, k: wordpiece.counted(d, PATH, k),
        "score": lambda d, k: quality.scored(d, w, k),
        "most_saved": lambda d, k: toxicity.scored(d, model, k),
        "labels": lambda d, k: licences.scanned(d, k),
        "component_id": lambda d, k: jaccard.joined(d, k),
        "text": lambda d, k: html.extracted(d, k),
    }
    for made, operator in operators.items():
        keep = tuple(c for c in odd.columns if c != made)
        out = operator(odd, keep)
        assert out.columns[: len(keep)] == list(keep) and out.count() == len(DOCS)
        assert {r.host for r in out.collect()} == {"host"} and {r.row for r in out.collect()} == {"row"}
        for wrong in (("doc_id", made), ("doc_id", "doc_id")):
            with pytest.raises(ValueError):
                operator(odd.withColumn(made, F.lit(1)) if made != "text" else odd, wrong)


def test_session_settings_come_back(spark, docs):
    common.release(spark)
    before = {k: v for k, v in spark.conf.getAll.items() if k != "spark.checkpoint.dir"}
    wordpiece.counted(docs, PATH).count()
    jaccard.joined(docs).count()
    common.release(spark)
    assert before == {k: v for k, v in spark.conf.getAll.items() if k != "spark.checkpoint.dir"}


def test_staged_folders_are_released(spark, docs):
    folder = common.shared_dir(spark).removeprefix("file://")
    common.release(spark)
    before = {*os.listdir(folder)} if os.path.isdir(folder) else set()
    jaccard.joined(docs).count()
    assert {*os.listdir(folder)} > before
    common.release(spark)
    assert {*os.listdir(folder)} == before


def test_small_tables_are_few_files(spark, monkeypatch):
    """However many partitions a shuffle has, no table staged beside few texts has more files than there are cores."""
    import corpus_pipeline

    common.release(spark)
    files, delete = {}, common.deleted
    monkeypatch.setattr(common, "deleted", lambda s, path: (files.update({path: sum(f.startswith("part-") for f in os.listdir(path.removeprefix("file://")))}), delete(s, path)))
    docs = spark.createDataFrame(list(enumerate(near_copies(random.Random(3), 240))), "doc_id bigint, text string")
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        kept = corpus_pipeline.drop_near_copies(spark, docs, "").count()
        found = decontaminate.contaminated(docs, docs.where("doc_id % 5 = 0").select(F.col("doc_id").alias("item_id"), "text")).count()
        common.release(spark)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 0 < kept < 240 and found >= 48
    assert len(files) > 5 and max(files.values()) <= spark.sparkContext.defaultParallelism


def test_no_local_folder_on_a_cluster():
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(dict)

        conf = {}

    with pytest.raises(RuntimeError):
        common.shared_dir(Cluster)


def test_jaccard_in_many_cells(spark, monkeypatch):
    """Batches that span several slices, cells that a partition counts one after the other, and shingles that many sets share."""
    rng = random.Random(5)
    shared = " ".join(f"s{k}" for k in range(12))
    texts = near_copies(rng, 240) + [shared + " " + t for t in near_copies(rng, 120)]
    monkeypatch.setattr(jaccard, "CELL_BYTES", 128)
    monkeypatch.setattr(jaccard, "FILL", 8)
    monkeypatch.setattr(jaccard, "COMMON", 5)
    assert jaccard.dealing(sum(map(len, texts)))[1] > jaccard.LEAST_PARTITIONS
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r.component_id for r in jaccard.joined(docs).orderBy("doc_id").collect()] == all_pairs(texts)


def test_jaccard_on_odd_rows(docs):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.joined(docs).collect())
    assert got == [(0, 1, None), (1, 3, 1), (1, 3, 1), (2, 0, 2), (3, 0, 3), (4, 2, 4), (5, 0, 5), (6, 3, 1)]


def near_copies(rng, n):
    texts, vocabulary = [], [f"w{k}" for k in range(3000)]
    for _ in range(n // 12):
        base = rng.choices(vocabulary, k=rng.randint(6, 150))
        for _ in range(12):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 25))):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            texts.append(" ".join(t[: len(t) - rng.randint(0, len(t) // 8)]))
    return texts


def test_jaccard_against_all_pairs(spark):
    texts = near_copies(random.Random(4), 480)
    sets = [plain_shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    got = {r.doc_id: r.component_id for r in jaccard.joined(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert got == {i: find(i) for i in range(len(texts))} and len({*got.values()}) < len(texts)


def all_pairs(texts):
    """The component of each text, named by its first text: every pair is compared."""
    sets = [plain_shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def test_jaccard_of_equal_batches(spark):
    """Batches that hold the same sets: a table beside itself, and more adjacent copies than batches have rows."""
    rng = random.Random(14)
    fresh = lambda n: [f"u{rng.randrange(10**6)}" for _ in range(n)]
    passage, p, q = fresh(60), fresh(60), fresh(60)
    twice = near_copies(rng, 60) + [" ".join(fresh(20) + passage + fresh(20)) for _ in range(12)]
    copied, unlike = " ".join(fresh(40) + p), [" ".join(p + q), *(" ".join(q + fresh(40)) for _ in range(10))]
    texts = [*twice, copied, *unlike]
    want = list(enumerate(all_pairs(texts)))
    assert len({c for _, c in want}) > 24
    copies = 4 * common.BATCH_ROWS
    n = len(twice)
    # Partitions of their own: Spark would put coalesced ones into one when they are united.
    one = lambda rows: spark.createDataFrame(spark.sparkContext.parallelize(rows, 1), "doc_id bigint, text string")
    docs = one(list(enumerate(twice)))
    got = jaccard.joined(docs.union(docs).union(one([(n, copied)] * copies + [(n + 1 + k, t) for k, t in enumerate(unlike)]))).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {*want} and len(got) == 2 * n + copies + len(unlike)


def test_components(spark):
    rng, n = random.Random(6), 300
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint"), len(edges)).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_components_are_never_left_split(spark):
    path = spark.createDataFrame([(k, k + 1) for k in range(30)], "a bigint, b bigint")
    with pytest.raises(RuntimeError):
        graph.components(path, 30, rounds=1)
    assert {r.root for r in graph.components(path, 30).collect()} == {0}


def test_hot_keys_meet(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 3000, F.lit(1)).otherwise(F.col("id")).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    assert graph.meet(rows, groups, "k", 5000).where("k <> 1 or m = 2999").count() == 5000


def test_crowded_keys_are_dealt(spark):
    rows = common.staged(spark.range(6000).select(F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).alias("k"), "id"), "rows")
    others = spark.range(6000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("m"))
    often = graph.crowded(rows.groupBy("k").agg(F.count("*").alias("n")), "k", 6000)
    assert [tuple(r) for r in often.collect()] == [(1, 667)]
    got = graph.meet_salted(rows, others, "k", often, "id").collect()
    assert len(got) == 6000 and all(r.m == 2 * r.k for r in got) and len({r.id for r in got}) == 6000


def test_warc_ranges(spark, tmp_path):
    """Shards follow the order of keys, whatever the keys are; only a key with more than a shard is dealt, by digest."""
    rows = [(k * 3, f"u{k}", (b"x%d" % k) * 50) for k in range(1000)] + [(1 << 62, "far", b"y"), (-(1 << 63), "low", b"z"), (None, "n", b"q")]
    rows += [(777, f"r{k}", (b"r%d" % k) * 100) for k in range(300)] + [(777, "same", b"s")] * 5 + [(3, "again", b"r7" * 100)]
    df = spark.createDataFrame(rows, "key bigint, url string, payload binary")
    manifests = []
    for k, n in enumerate((1, 7)):
        path = f"file://{tmp_path}/{k}"
        manifest = warc.write(df.repartition(n), path, roll_bytes=5000, shard_bytes=60_000)
        manifests.append([tuple(r) for r in manifest.select("shard", "seq", "name", "bytes", "sha1", "records", "first_key", "last_key").orderBy("shard", "seq").collect()])
    assert manifests[0] == manifests[1]
    least = lambda key: -(1 << 70) if key is None else key
    for a, b in zip(manifests[0], manifests[0][1:]):
        assert least(a[7]) <= least(b[6])
    single = {m[0] for m in manifests[0] if m[6] == m[7] == 777}
    assert len(single) > 3 and len({m[0] for m in manifests[0]} - single) > 3 and max(m[1] for m in manifests[0]) > 0
    got = warc.read(spark, path).collect()
    assert len(got) == len(rows) and [(r.key, r.refers_to) for r in got if r.record_type == "revisit"] == [(3, 777)]


def test_warc(spark, tmp_path):
    rows = [(1, "u", b"a"), (2, "u", b"a"), (2, "v", b"a"), (3, None, None), (4, "w", b""), (None, "n", b"a"), (5, "x", b"z" * 100000)]
    df = spark.createDataFrame(rows, "key bigint, url string, payload binary")
    manifests = []
    for k, n in enumerate((1, 5)):
        path = f"file://{tmp_path}/{k}"
        m = warc.write(df.repartition(n), path, roll_bytes=600, shard_bytes=1000)
        manifests.append(sorted((r.name, r.bytes, r.sha1, r.records) for r in m.collect()))
        got = sorted(((r.key or 0), r.record_type, r.refers_to, r.payload_bytes) for r in warc.read(spark, path).collect())
        assert got == [(0, "revisit", 2, 1), (1, "revisit", 2, 1), (2, "response", None, 1), (2, "response", None, 1), (3, "revisit", 4, 0), (4, "response", None, 0), (5, "response", None, 100000)]
        assert not list((tmp_path / str(k)).glob("_temporary")) and len(list((tmp_path / str(k)).glob("*.warc.gz"))) == len(manifests[-1])
    assert manifests[0] == manifests[1] and len(manifests[0]) > 1
    big = [r.payload for r in warc.read(spark, path, payloads=True).where("key = 5").collect()]
    assert bytes(big[0]) == b"z" * 100000
    none = spark.createDataFrame([], "key bigint, url string, payload binary")
    warc.write(none, f"file://{tmp_path}/none")
    assert warc.read(spark, f"file://{tmp_path}/none").count() == 0


def test_html_consensus(spark):
    page = "<div class=menu-x><p>{}</p></div><div class='body-{}'><p>{}</p></div>"
    rows = [(k, "http://a.example/x", page.format("menu text", k, "the real text of this page " * 3)) for k in range(20)]
    rows += [(20, "http://A.example:80/y", page.format("a very long passage outside of the winning path " * 20, 20, "short")), (21, None, None), (22, "http://b.example/", "<p>only</p>"), (23, "", "")]
    got = {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[20] == "short" and got[21] == "" and got[22] == "only" and got[23] == "" and len(got) == 24
    assert html.extracted(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_decontamination(spark):
    rng = random.Random(7)
    fresh = lambda n: [f"t{rng.randrange(10**6)}" for _ in range(n)]
    item = fresh(30)
    swapped = list(item)
    for k in (3, 8, 15, 20, 27):
        swapped[k] = "other"
    few = list(item)
    for k in range(0, 30, 4):
        few[k] = "other"
    texts = {1: fresh(20) + item + fresh(5), 2: swapped, 3: few, 4: item[:12] + fresh(20), 5: item[:13] + fresh(20), 6: [], 7: fresh(4) + item[-13:]}
    rows = [(k, " ".join(t).upper()) for k, t in texts.items()] + [(8, None), (None, " ".join(item)), (1, "again")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([(0, " ".join(item)), (1, None), (2, "not there"), (None, " ".join(item)), (3, " ,")], "item_id bigint, text string")
    got = {r.doc_id: (r.item_id, r.doc_word, r.matched) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {1: (0, 20, 30), 2: (0, 0, 25), 4: (0, 0, 12), 5: (0, 0, 13), 7: (0, -13, 13)}
    left = decontaminate.decontaminated(docs, items)
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 3, 6, 8]
    assert decontaminate.contaminated(docs.limit(0), items).count() == decontaminate.contaminated(docs, items.limit(0)).count() == 0


def test_decontamination_of_short_items(spark, db):
    """Items of fewer words than a window, against the SQL that compares all places."""
    rng = random.Random(17)
    fresh = lambda n: [f"t{rng.randrange(10**6)}" for _ in range(n)]
    items = {n: fresh(n) for n in (1, 2, 3, 5, 7, 8, 9, 12, 13)}
    texts, k = {}, 0
    for words in items.values():
        for errors in (0, 1, 2):
            for at in range(3):
                t = list(words)
                for e in rng.sample(range(len(t)), min(errors, len(t))):
                    t[e] = "other"
                texts[k] = " ".join([*fresh(at * 3), *t, *fresh(4)])
                k += 1
    docs = spark.createDataFrame([*texts.items(), (900, " ".join(items[7])), (901, None), (902, "")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id bigint, text string")
    got = {tuple(r) for r in decontaminate.contaminated(docs, bench).collect()}
    c = duckdb.connect()
    c.register("documents", docs.toPandas())
    c.register("benchmark", bench.toPandas())
    assert got == {*c.execute(decontaminate.ORACLES["op7_decontamination"]).fetchall()}
    assert (900, 7, 0, 7) in got and {r[1] for r in got} == {*items}


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 12)).astype(np.float32)
    x[300:400] = x[100]
    rows = [(k, x[k].tolist(), "t") for k in range(900)] + [(1000, None, ""), (1100, [0.0] * 12, ""), (1200, [float("nan")] + [1.0] * 11, ""), (1300, [None] + [1.0] * 11, ""), (None, [1.0] * 12, ""), (1400, [1.0, 2.0], ""), (1500, [], "")]
    good = neighbours.usable(spark.createDataFrame(rows, "id bigint, v array<float>, score string"))
    assert good.count() == 901
    own = good.where("dim = 12").select("id", "v")
    got = neighbours.nearest(own, own.where("id % 100 = 0"), 12, block=200).collect()
    found, hits = {}, 0
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r.vec_id)
    for q, ids in found.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        hits += len({*ids} & {*np.lexsort((np.arange(900), d))[:10].tolist()})
    assert len(found) == 9 and hits / 90 >= 0.9 and found[100] == list(range(300, 310))
    lone = good.where("dim = 2").select("id", "v")
    assert neighbours.nearest(lone, lone, 2).count() == 0


def test_neighbours_of_a_repeated_query_row(spark):
    rows = [(1, [1.0, 2.0])] * 15 + [(2, [1.0, 2.0]), (3, [1.0, 2.0]), (4, [5.0, 2.0])]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    got = neighbours.nearest(df, df.where("id = 1").limit(1), 2).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [2, 3, 4]
    # A repeated query gets its answer as often; an empty table has none.
    got = neighbours.nearest(df, df.where("id = 1").limit(2), 2).collect()
    assert sorted((r.rank, r.vec_id) for r in got) == [(1, 2), (1, 2), (2, 3), (2, 3), (3, 4), (3, 4)]
    assert neighbours.nearest(df.limit(0), df.limit(0), 2).count() == 0


def test_neighbours_in_many_blocks(spark):
    """Cells of several blocks, and a repeated query row among them: against all distances."""
    rng = np.random.default_rng(13)
    x = rng.standard_normal((1200, 8))
    rows = [(k, x[k].tolist()) for k in range(1200)] + [(0, x[0].tolist())]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    got = neighbours.nearest(df, df.where("id % 100 = 0"), 8, block=50, sample=64).collect()
    assert len(got) == 130
    hits = 0
    for q in range(0, 1200, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        own = [r for r in got if r.query_id == q]
        assert sorted({r.rank for r in own}) == list(range(1, 11)) and all(abs(d[r.vec_id] - r.score) < 1e-12 for r in own)
        hits += len({r.vec_id for r in own} & {*np.argsort(d)[:10].tolist()})
    assert hits / 120 >= 0.9


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for name in ("pages", "documents", "benchmark", "embeddings"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return c


@pytest.mark.parametrize("name", ["op1_warc", "op6_ngram_jaccard", "op7_decontamination"])
def test_same_rows_as_sql(spark, db, name):
    got, want = __spark_entry__.queries()[name](spark, SF).toPandas(), db.execute(__spark_entry__.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    text = lambda f: sorted(map(repr, f[columns].astype(object).where(f[columns].notna(), None).map(lambda v: int(v) if isinstance(v, float) else v).itertuples(index=False, name=None)))
    assert text(got) == text(want)


def test_queries_against_plain_versions(spark, db):
    texts = dict(db.execute("SELECT doc_id, text FROM documents").fetchall())
    queries = __spark_entry__.queries()
    scans = {r.doc_id: tuple(r)[1:6] for r in queries["op9_licence_scan"](spark, SF).collect()}
    assert scans == {k: plain_scan(t) for k, t in texts.items()}
    library, sha = pieces.encoder(PATH).library, lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {k: library.encode(t or "") for k, t in texts.items()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries["op2_sentencepiece"](spark, SF).collect()}
    assert got == {k: (len(i), sha(",".join(map(str, i))), sha(library.decode(i))) for k, i in want.items()}
    first, rest = wordpiece.vocabulary(PATH)
    words = {k: wordpiece.WORDS.findall(t or "") for k, t in texts.items()}
    longest = functools.lru_cache(None)(lambda w: wordpiece.longest_match(w, first, rest))
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in queries["op4_token_counts"](spark, SF).collect()} == {k: (len(w), sum(map(longest, w))) for k, w in words.items()}
    for name in ("op5_quality_classifier", "op10_toxicity"):
        rows = queries[name](spark, SF).collect()
        assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


class Article(HTMLParser):
    """The blocks of a page's article, by the standard library's parser: slow, and for pages that have one."""

    def __init__(self, page):
        super().__init__()
        self.inside, self.blocks, self.text = 0, [], []
        self.feed(page)
        self.close()

    def flush(self):
        block = " ".join("".join(self.text).split())
        self.text = []
        if block:
            self.blocks.append(block)

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if self.inside and tag in ("p", "h1", "article"):
            self.flush()
        elif tag == "br":
            self.text.append(" ")

    def handle_endtag(self, tag):
        if self.inside and tag in ("p", "h1", "article"):
            self.flush()
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.text.append(data)


def test_html_against_another_parser(spark, db):
    pages = dict(db.execute("SELECT page_id, html FROM pages").fetchall())
    got = {r.page_id: (r.text, r.n_chars) for r in __spark_entry__.queries()["op3_html_extraction"](spark, SF).collect()}
    want = {k: "\n\n".join(Article(h).blocks) for k, h in pages.items()}
    assert got == {k: (t, len(t)) for k, t in want.items()} and any(want.values())


def test_html_hosts_decide_on_looks(spark):
    """What most pages of a host say of a wrapper and of a box holds on a page that looks otherwise."""
    page = "<div class='site has-sidebar'><div class=text><p>{}</p></div></div><div class='box-promo'><p>{}</p></div><p>{}</p>"
    long, short = "the real text of this page " * 9, "a few words"
    rows = [(k, "http://a.example/", page.format(long, short, "x")) for k in range(20)] + [(20, "http://a.example/", page.format(short, short, long))]
    rows += [(30 + k, "http://b.example/", page.format(short, short, long)) for k in range(5)]
    got = {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[0] == long.strip() and got[20] == short and got[30] == long.strip()


def test_repeated_pages_stay(spark):
    rows = [(1, "http://a.example/", "<article><p>x</p></article><nav>n</nav>")] * 3 + [(1, None, "<p>y</p>")]
    got = html.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(1, "x")] * 3 + [(1, "y")]


def test_neighbours_of_the_query_against_all_distances(spark, db):
    rows = [(k, np.array(v, float)) for k, v in db.execute("SELECT vec_id, embedding FROM embeddings").fetchall() if k is not None and v is not None and None not in v]
    rows = [(k, v) for k, v in rows if np.isfinite(v).all() and v.any()]
    ids, x = np.array([k for k, _ in rows]), np.array([v for _, v in rows])
    got = __spark_entry__.queries()["op8_nearest_neighbours"](spark, SF).collect()
    hits = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11)) and [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        assert all(r.vec_id != q and abs(d[ids == r.vec_id][0] - r.score) < 1e-12 for r in own)
        d[ids == q] = np.inf
        hits += len({r.vec_id for r in own} & {*ids[np.lexsort((ids, d))[:10]].tolist()})
    assert hits >= 0.9 * len(got) > 0


@pytest.mark.parametrize("name, label, positive, least", [("op5_quality_classifier", "quality", 0, 0.9), ("op10_toxicity", "toxic", 1, 0.7)])
def test_classifiers_on_held_out_labels(spark, name, label, positive, least):
    """F1 of the rarer class over the held-out labelled rows."""
    found = {r.doc_id: r.predicted for r in __spark_entry__.queries()[name](spark, LARGER).where("held_out").collect()}
    rows = duckdb.sql(f"SELECT doc_id, {label} FROM '{LARGER}/labels.parquet' WHERE {label} IS NOT NULL").fetchall()
    pairs = [(found[k], y) for k, y in rows if k in found]
    true = sum(p == y == positive for p, y in pairs)
    assert len(pairs) > 50 and 2 * true >= least * sum((p == positive) + (y == positive) for p, y in pairs)


def test_conflicting_labels(spark, docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (3, 1)], "doc_id bigint, label int")
    assert quality.scored(docs, quality.fit(docs, labels)).where("score between 0 and 1").count() == len(DOCS)
    assert toxicity.scored(docs, toxicity.fit(docs, labels)).where("score between 0 and 1").count() == len(DOCS)


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("clash"))
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count(), name
        docs = out
    last = p.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count()
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in p.STAGES:
        assert stage(spark, empty, SF).count() == 0
