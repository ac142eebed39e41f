"""Near duplicates, components, top-k search, WARC, url rules and the classifier."""

import base64
import gzip
import hashlib
import re
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import cotraining, graph, near_dup, topk, url_filter, warc
from tallyline.sources.stage import new_path

SF_DIR = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def brute_components(docs):
    """Smallest reachable doc_id by all pairs."""
    sets = {i: shingles(t) for i, t in docs}
    label = {i: i for i in sets}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(500)]
    docs, number = [], 0
    for _ in range(12):
        base = list(rng.choice(vocabulary, 120))
        for change in (0, 0, 1, 3, 6, 9, 20):
            own = list(base)
            for place in rng.choice(120, change, replace=False):
                own[place] = str(rng.choice(vocabulary))
            docs.append((number, " ".join(own)))
            number += 1
    # A chain: neighbours are similar, the ends are not.
    chain = list(rng.choice(vocabulary, 200))
    for step in range(10):
        docs.append((number, " ".join(chain[step * 8 : step * 8 + 120])))
        number += 1
    edges = [(900, ""), (901, None), (902, "One two"), (903, "one  TWO"), (904, "a b c d"), (905, "\n")]
    rows = docs + edges
    df = spark.createDataFrame(
        [(i, t, "x") for i, t in [*rows, (902, "One two"), (None, "one two")]],
        "doc_id BIGINT, text STRING, component_id STRING",
    )
    want = brute_components(rows)
    got = near_dup.near_duplicates(df).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == want[r.doc_id])
            assert r.n_shingles == len(shingles(dict(rows)[r.doc_id]))
    left = near_dup.deduplicated(df)
    assert left.columns == df.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in set(ids) if i is not None) == sorted(set(want.values()))


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert near_dup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("size", [20, 150, 1500, 6000])
def test_odd_sketch_tells_high_similarity(spark, size):
    """Pairs at the threshold pass the bound, pairs well below it do not."""
    rng = np.random.default_rng(size)
    bound = spark.range(1).selectExpr(f"{near_dup.most_sketch_bits(f'{size}L', f'{size}L')} AS b").first().b

    def passing(similarity, trials):
        shared, good = int(np.ceil(2 * similarity / (1 + similarity) * size)), 0
        for _ in range(trials):
            pool = rng.integers(0, 2**63, 2 * size - shared).astype(np.uint64) * np.uint64(2)
            both = np.concatenate([np.sort(pool[:size]), np.sort(pool[size - shared :])])
            sketches = near_dup.odd_sketches(both, np.array([0, size, 2 * size])).view(np.uint64)
            good += sum(int(x ^ y).bit_count() for x, y in zip(*sketches, strict=True)) <= bound
        return good / trials

    assert passing(0.75, 200) == 1
    assert passing(0.45, 50) == 0


def test_components_of_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(60) if i != 30] + [(100, 99), (5, 5)]
    links = spark.createDataFrame(pairs, "a BIGINT, b BIGINT")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {i: 0 if i <= 30 else 31 for i in range(61)} | {99: 99, 100: 99}


def test_top_k_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=8).round(2)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 340)]  # ties
    rows += [(350, [0.5] * 8), (350, [0.25] * 8)]  # a repeated id: the larger counts
    odd = [(400, None), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] * 8), (403, [float("inf")] * 8)]
    odd += [(None, [9.0] * 8), (450, [])]
    df = spark.createDataFrame(
        [(i, v, 1) for i, v in rows + odd], "vec_id BIGINT, embedding ARRAY<DOUBLE>, score INT"
    )
    ints = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows} | {350: np.array([128] * 8)}
    ints[450] = np.zeros(8, int)
    vectors = topk.quantized(df)
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0")).collect()
    want = {}
    for q in (i for i in ints if i % 50 == 0):
        best = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q)[:5]
        want |= {(q, n): (i, -s) for n, (s, i) in enumerate(best, 1)}
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == want
    one = vectors.where("vec_id = 0")
    assert topk.top_k(one, one).count() == topk.top_k(vectors.limit(0), one.limit(0)).count() == 0


def test_search_prunes_and_stays_exact():
    rng = np.random.default_rng(2)
    m = np.repeat(rng.integers(-300, 300, (6, 16)), topk.BLOCK, axis=0) + rng.integers(-3, 3, (6 * topk.BLOCK, 16))
    ids = np.arange(len(m)) * 3
    q_ids, q = ids[::700], m[::700]
    for scale in (1, 10**6):  # the second needs whole-number arithmetic
        row, found, score = topk.search(q_ids, q * scale, ids, m * scale, 5)
        for i, own in enumerate(q_ids):
            all_ = sorted((-int(s), int(x)) for s, x in zip(m @ q[i], ids, strict=True) if x != own)[:5]
            assert [(int(-s) // scale**2, int(x)) for s, x in zip(score[row == i], found[row == i], strict=True)] == all_


def test_warc_round_trip(spark, tmp_path):
    pages = [
        (1, "http://a/", "same"), (2, None, "same"), (3, "http://b/\r\nX: y", "same"), (4, "u", None), (5, "u", ""),
        (6, "u", "WARC/1.1\r\nfake\r\n\r\n"), (7, "ü", "é" * 50_000), (8, "u", "once"), (8, "u", "once"), (None, "u", "x"),
    ]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id BIGINT, url STRING, html STRING, refers_to STRING")
    path = new_path(spark, "warc-test")
    warc.write(df, path)
    rows = warc.records(spark, path).collect()
    assert len(rows) == len(pages)
    html = {i: (h or "").encode() for i, _, h in pages}
    for r in rows:
        body = html[r.page_id]
        assert r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert bytes(r.payload) == body if r.record_type == "response" else r.payload is None
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in rows}
    assert kinds[1] == kinds[2] == ("revisit", 3) and kinds[4] == ("revisit", 5)
    assert kinds[3] == kinds[5] == kinds[8] == ("response", None)
    # Header predicates reach the source; a header schema decodes no payload.
    some = warc.headers(spark, path).where("record_type = 'revisit' AND page_id > 1")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "record_type" in plan and sorted(r.page_id for r in some.collect()) == [2, 4]
    assert warc.records(spark, path).where("page_id IN (1, 7)").count() == 2
    nothing = new_path(spark, "warc-test")
    warc.write(df.limit(0), nothing)
    assert warc.records(spark, nothing).count() == 0


def test_warc_reader_keeps_header_filters():
    from pyspark.sql import datasource as D
    from pyspark.sql.types import _parse_datatype_string  # noqa: F401
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("page_id", LongType()), StructField("record_type", StringType())])
    reader = warc.WarcReader(schema, {"path": "/nowhere"})
    other = D.StringContains(("target_uri",), "x")
    pushed = [D.EqualTo(("record_type",), "response"), D.GreaterThan(("page_id",), 4), other]
    assert list(reader.pushFilters(pushed)) == [other]
    row = {"page_id": 5, "record_type": "response"}
    assert reader.wanted(row) and not reader.wanted(row | {"page_id": 4}) and not reader.wanted(row | {"page_id": None})


URLS = [
    ("http://Example.COM/en/1", "example.com/en/"), ("https://www.example.com/en/2?x=1", "www.example.com/en/"),
    ("http://a.www.example.com/en/", "www.example.com/en/"), ("http://notexample.com/en/3", "com/"),
    ("http://x.net/es/1", "net/es/"), ("http://x.net/fr/2#y", "net/fr/"), ("http://x.net/en/3", None),
    ("http://x.org", None), ("http://x.com", None), ("http://x.com?/", None), ("no scheme", None), (None, None),
    ("", None), ("a://b://c.net/es/", None), ("http://x.com/" + "a" * 50_000, "com/"),
]


def test_url_rules_and_edges(spark):
    rows = [(i, u, "c") for i, (u, _) in enumerate(URLS)] + [(None, URLS[0][0], "c"), (0, URLS[0][0], "c")]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, judged STRING")
    got = url_filter.judged(df).select("page_id", "judged.*").collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    verdict = {r.text: r.verdict for r in url_filter.RULES}
    for i, (url, rule) in enumerate(URLS):
        assert by[i].rule == rule, url
        assert by[i].verdict == verdict[rule] if rule else by[i].verdict in ("allow", "block")
    assert (by[0].host, by[0].path) == ("example.com", "/en/1")
    assert (by[9].host, by[9].path) == ("x.com", "") and (by[10].host, by[11].path) == ("", "")
    assert url_filter.judged(df.limit(0)).count() == 0
    only = url_filter.judged(df.where("page_id IN (6, 11)")).select("judged.*").collect()
    assert {r.verdict for r in only} == {"allow"}


def test_url_model_learns_labelled_urls(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    rows = url_filter.judged(pages).select("judged.*").collect()
    known = [r for r in rows if r.rule is not None]
    right = sum((r.score > 0.5) == (r.verdict == "block") for r in known)
    assert right >= 0.9 * len(known)


def test_url_rates_leave_out_the_own_fold(spark):
    """A training row's rates come from other hosts only, all others from every host."""
    rows = [("a", "s", 0, 1.0), ("b", "s", 0, 1.0), ("c", "s", 1, 0.0), ("d", "t", 2, 1.0)]
    urls = spark.createDataFrame(rows, "host STRING, suffix STRING, fold INT, label DOUBLE")
    tables = {"suffix": url_filter.sums(urls, "suffix")}
    half, prior = url_filter.PRIOR / 2, url_filter.PRIOR
    apart = {r.host: r.suffix_rate for r in url_filter.with_rates(urls, tables, True).collect()}
    assert apart == {h: pytest.approx(v) for h, v in {"a": half / (1 + prior), "b": half / (1 + prior), "c": (2 + half) / (2 + prior), "d": 0.5}.items()}
    whole = {r.host: r.suffix_rate for r in url_filter.with_rates(urls.drop("fold"), tables, False).collect()}
    assert whole["a"] == whole["c"] == pytest.approx((2 + half) / (3 + prior))


def test_url_scores_of_unruled_urls_differ(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = url_filter.judged(pages).select("judged.*").collect()
    assert len({round(r.score, 6) for r in rows if r.rule is None}) > 2


@pytest.fixture(scope="module")
def labelled(spark):
    return (
        spark.read.parquet(f"{SF_DIR}/documents.parquet"),
        spark.read.parquet(f"{SF_DIR}/labels.parquet"),
    )


def test_classifier_on_held_out_labels(spark, labelled):
    """Fitted on half of the labels, right on the other half."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = {r.doc_id: r for r in cotraining.score(docs, labels.where("doc_id % 2 = 0")).collect()}
    test = labels.where("doc_id % 2 = 1").collect()
    good = [rows[r.doc_id] for r in test if r.quality > 0]
    bad = [rows[r.doc_id] for r in test if r.quality == 0]
    ranked = sum((g.score > b.score) + 0.5 * (g.score == b.score) for g in good for b in bad)
    assert ranked >= 0.96 * len(good) * len(bad)
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    # A few dozen bad examples: the cautious threshold keeps most of the doubtful ones.
    assert sum(not r.kept for r in bad) >= 0.25 * len(bad)


def test_scores_keep_the_label_mix_of_the_whole_table(spark, monkeypatch):
    """A sample that cuts the larger class means the same as one that cuts nothing."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    share = labels.selectExpr("avg(quality)").first()[0]
    monkeypatch.setattr(cotraining, "LABELLED", 60)
    model = cotraining.train(cotraining.training_rows(docs, labels))
    assert model.prior == pytest.approx(np.log(share / (1 - share)))
    scores = [r.score for r in cotraining.score(docs, labels).collect()]
    assert np.mean(scores) == pytest.approx(share, abs=0.08)


def test_threshold_keeps_good_documents_and_rejects_bad_ones(spark):
    """On half of the labels of sf0.1, nearly all bad documents of the other half go."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = cotraining.score(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    kept = {r.quality: r.share for r in rows.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] >= 0.98 and kept[0] <= 0.015


def test_threshold_is_one_rule_at_every_size():
    """The rank rises with the number of scores without a jump and stays near the wanted share."""
    ranks = []
    for n in (1, 2, 10, 100, 150, 200, 250, 298, 299, 300, 1000, 4000, 40_000):
        scores = np.arange(1, n + 1) / n
        ranks.append(cotraining.threshold(scores) * n)
        assert ranks[-1] <= cotraining.LOST * n
        assert cotraining.threshold(scores[::-1]) * n == pytest.approx(ranks[-1])
    assert all(0 < a < b for a, b in zip(ranks, ranks[1:]))
    assert ranks[-1] > 0.9 * cotraining.LOST * 40_000
    assert cotraining.threshold(np.zeros(0)) == 0


def test_folds_never_see_their_own_labels(spark, labelled):
    """Flipping a fold's labels changes no score that the fold gets while it is left out."""
    docs, labels = labelled
    examples = cotraining.training_rows(docs, labels)
    folds = {r.doc_id: r.fold for r in examples.sample.select("doc_id", "fold").collect()}
    assert set(folds.values()) == set(range(cotraining.FOLDS))
    one = [i for i, fold in folds.items() if fold == 0]
    flipped = labels.withColumn("quality", F.when(F.col("doc_id").isin(one), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = replace(
        examples,
        sample=examples.sample.drop("label").join(flipped.select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id"),
    )
    for run, same in ((1, True), (0, False)):
        a, b = (cotraining.fit_all(e, None)[run].text for e in (examples, other))
        assert np.allclose(a, b, atol=1e-6) == same


def test_regression_converges_to_the_least_loss():
    rng = np.random.default_rng(2)
    n, counts = 500, rng.integers(0, 6, 500)
    rows = cotraining.Rows(rng.integers(0, 40, counts.sum()), rng.random(counts.sum()), counts, 40)
    dense, weight = rng.normal(size=(n, 3)), rng.random(n) + 0.5
    label = (dense[:, 0] + 0.5 * rng.normal(size=n) > 0).astype(float)
    w, base, steps = cotraining.regression(dense, rows, label, weight)

    def loss(w, base):
        odds = dense @ w[:3] + rows.times(w[3:]) + base
        return weight @ np.logaddexp(0, -(2 * label - 1) * odds) / weight.sum() + cotraining.PENALTY / 2 * w @ w

    assert steps < cotraining.STEPS and w[0] > 1
    for _ in range(50):
        assert loss(w + 0.05 * rng.normal(size=len(w)), base + 0.05 * rng.normal()) > loss(w, base) - 1e-4
    assert np.isfinite(cotraining.regression(dense[:2], cotraining.Rows(rows.places[:0], rows.values[:0], np.zeros(2, int), 40), np.array([1.0, 0]), np.ones(2))[0]).all()


def test_stored_features_are_those_of_the_texts(spark, labelled):
    docs, labels = labelled
    table = cotraining.feature_table(docs.select(*cotraining.NEEDED))
    model = cotraining.Classifier(
        cotraining.Weights(np.linspace(-1, 1, cotraining.DENSE + cotraining.HASHED), 0.1, np.linspace(-1, 1, cotraining.HASHED), 0.2),
        (1.0, 0.5), (0.0, 0.1), 0.3, 0.5,
    )
    scores = [r.score for r in model.of_table(table).collect()]
    model = replace(model, reject=float(np.median(scores)))
    stored = {r.doc_id: r.kept for r in model.of_table(table).collect()}
    direct = {r.doc_id: r.k for r in docs.select("doc_id", model.verdict().alias("k")).collect()}
    assert stored == direct and len(set(stored.values())) == 2


def test_foreign_archives(spark, tmp_path):
    """Gzip members, folded headers, ids of other writers; no file is skipped in silence."""
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i % 3}</p>" * 50) for i in range(20)], "page_id BIGINT, url STRING, html STRING")
    folder = str(tmp_path / "own")
    warc.write(pages.coalesce(1), folder)
    want = sorted(map(tuple, warc.records(spark, folder).collect()), key=repr)
    own = next((tmp_path / "own").glob("*.warc")).read_bytes()
    cuts = [m.start() for m in re.finditer(rb"WARC/1\.1", own)] + [len(own)]
    packed = tmp_path / "gz"
    packed.mkdir()
    (packed / "a.warc.gz").write_bytes(b"".join(gzip.compress(own[a:b]) for a, b in zip(cuts, cuts[1:])))
    assert sorted(map(tuple, warc.records(spark, str(packed)).collect()), key=repr) == want
    assert warc.headers(spark, str(packed)).where("record_type = 'revisit'").count() == 17

    block = b"HTTP/1.1 200 OK\r\n\r\nhello"
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:x>\r\nWARC-Target-URI: http://a/\r\n  b\r\nContent-Length: %d\r\n\r\n" % len(block)
    other = tmp_path / "other"
    other.mkdir()
    (other / "b.warc").write_bytes((head + block + b"\r\n\r\n") * 2)
    rows = warc.records(spark, str(other)).collect()
    assert [(r.page_id, r.target_uri, bytes(r.payload), r.payload_digest) for r in rows] == [(None, "http://a/ b", b"hello", None)] * 2
    (other / "c.warc.zst").write_bytes(b"")
    with pytest.raises(Exception, match="not an archive"):
        warc.records(spark, str(other)).count()


def test_classifier_edges(spark, labelled):
    docs, labels = labelled
    odd = spark.createDataFrame(
        [(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, "text", "en", "s", 4), (9003, "x " * 50_000, "zz", "s", 9)],
        docs.schema,
    )
    both = docs.union(odd).union(docs.limit(3))
    rows = cotraining.score(both, labels).collect()
    assert len(rows) == both.count() and all(0 <= r.score <= 1 for r in rows)
    none = labels.limit(0)
    assert all(r.score == 1 and r.kept for r in cotraining.score(odd, none).collect())
    wide = odd.selectExpr("*", "'c' AS score", "'d' AS meta_vector")
    left = cotraining.kept(wide, none)
    assert left.columns == wide.columns and left.count() == 4
    assert cotraining.score(docs.limit(0), labels).count() == 0
