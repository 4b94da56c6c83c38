"""Prefix trie, repeated phrases and importance draw against SQL and brute force on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from promolens.llm import decontaminate, html_wrapper, importance, language_id, line_crf, mixing, prefix_trie, queries, repeated_phrases, rule_ensemble, sharding, shingle_join, token_index, url_filter

SF = "/root/testdata/sf0.001"
BIG = [2**53 + 1, -(2**53 + 1), 2**63 - 1]
rng = random.Random(8)
VOCABULARY = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(300)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def awkward_documents():
    passage, base = prose(60, 1), prose(90, 2)
    near = base.split()
    near[45] = "changed"
    texts = [
        (1, None), (2, ""), (3, " \t\n\x0b "), (4, "one two three"), (5, passage), (6, prose(20, 3) + "\n" + passage + "  " + prose(15, 4)), (7, base), (8, " ".join(near)),
        (9, base), (9, base), (9, base + " more"), (None, base), (None, prose(30, 5)), (None, prose(30, 5)), (10, passage[:200]), (11, "word " * 50), (12, "word " * 40),
        (13, "É é ABC abc %$# 12 " * 9), (14, "😀 a\x00b c\x1fd e\x85f   " * 8), (0, passage + " " + prose(14, 6)), (-5, prose(13, 7)), (15, prose(14, 7)),
        *[(i, prose(25, 9)) for i in BIG], (16, prose(60_000, 10)), (17, prose(5_000, 10)),
    ]
    return [(i, t, "a", 1, "p", "k", 5) for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(awkward_documents(), "doc_id long, text string, source string, n_words int, part string, block string, score int").repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def rows_of(frame):
    cols = sorted(frame.columns)
    plain = lambda v: None if pd.isna(v) else v if isinstance(v, (str, bool)) else int(v)
    return cols, sorted((tuple(plain(v) for v in r) for r in frame[cols].astype(object).itertuples(index=False, name=None)), key=repr)


def collected(df):
    return pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns, dtype=object)


def same_as_sql(result, sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(f"{name}_arrow", df.toArrow())
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_arrow")
    other = con.execute(sql).fetchall()
    names = [c[0] for c in con.description]
    assert rows_of(collected(result)) == rows_of(pd.DataFrame(other, columns=names, dtype=object))


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_repeated_phrases", "op13_importance"])
def test_query_equals_sql(spark, name):
    tables = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark", "conversations")}
    same_as_sql(queries.QUERIES[name](spark, SF), queries.SQL[name], **tables)


# Prefix trie


def conversations(spark):
    text = lambda k: f"turn {k} ü"
    rows = []
    for c in [0, 1, 2, 3, 101, 102, 150, 200, 205, -1, -100, -101, *BIG, 300]:
        rows += [(c, t, "user" if t % 2 else None, text(t % 3 if t < 2 else c % 2 + t)) for t in range(c % 9 + 1)]
    rows += [(c, 0, "user", "the same") for c in range(400, 440)]  # equal conversations after the first turns
    rows += [(500, None, "user", "first"), (500, 1, "a", None), (500, 1, None, "tie"), (500, 1, None, "tie"), (500, 1, "a", "tie"), (None, 0, "user", "nobody"), (501, 3, "user", "long " * 30_000)]
    rows += [(600, t, "user", f"{t}") for t in range(200)] + [(601, t, "user", f"{t}") for t in range(150)]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, digests string").repartition(4)


@pytest.mark.parametrize("part_turns", [1, 40, 100_000])
def test_trie_over_any_number_of_ranges(spark, part_turns):
    rows = conversations(spark)
    same_as_sql(prefix_trie.trie(prefix_trie.rebuilt(rows), part_turns=part_turns), prefix_trie.SQL, conversations=rows)


def test_trie_of_nothing(spark):
    rows = conversations(spark).where("conv_id is null")
    assert prefix_trie.trie(prefix_trie.rebuilt(rows)).count() == 0
    assert prefix_trie.trie(prefix_trie.rebuilt(rows.limit(0))).count() == 0


def test_trie_of_conversations_without_turns(spark):
    alone = [c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 6 > 0][:5]
    rows = spark.createDataFrame([(c, 0, "user", "only") for c in alone], "conv_id long, turn long, role string, text string")
    root = prefix_trie.trie(prefix_trie.rebuilt(rows)).collect()
    ids = ",".join(map(str, sorted(alone)))
    assert [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in root] == [
        (min(alone), 0, None, 5, 0, 1, 0, hashlib.sha256(ids.encode()).hexdigest())]


def test_extents_equal_a_plain_scan():
    r = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64, 100):
        values = r.integers(0, 5, n)
        values[0] = -1
        row, depth = np.repeat(np.arange(n), 6), np.tile(np.arange(6), n)
        left, right = prefix_trie.RangeMinimum(values).extents(row, depth)
        for i, d, a, b in zip(row, depth, left, right):
            low, high = i, i
            while low > 0 and values[low] >= d:
                low -= 1
            while high + 1 < n and values[high + 1] >= d:
                high += 1
            assert (a, b) == (low, high)
            assert prefix_trie.RangeMinimum(values).least(np.array([a]), np.array([b]))[0] == values[a:b + 1].min()


# Repeated phrases


def kept_words(rows, width=13):
    """Brute force: (n_words, words left) per row in the given order."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for p in range(len(w) - width + 1):
            key, at = tuple(w[p:p + width]), float("inf") if i is None else i
            first[key] = min(first.get(key, at), at)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for p in range(len(w) - width + 1):
            if first[tuple(w[p:p + width])] < (float("inf") if i is None else i):
                gone.update(range(p, p + width))
        out.append((i, len(w), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [{}, {"block": 700, "bucket": 300, "shard": 11}, {"block": 1, "bucket": 1_000}, {"block": 1 << 30, "shard": 1}])
def test_repeats_equal_brute_force(docs, sizes):
    found = repeated_phrases.remove_repeats(docs, **sizes).collect()
    assert sorted([(r.doc_id, r.n_words, r.kept) for r in found], key=repr) == kept_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    for r in found:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed == r.n_words - len([x for x in r.kept.split(" ") if x])


def test_repeats_among_many_near_copies(spark):
    base = prose(120, 20).split()
    texts = []
    for i in range(150):
        words = list(base)
        for p in random.Random(i).sample(range(120), 3):
            words[p] = f"x{i}{p}"
        texts.append((i * 3 % 151, " ".join(words)))
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    found = repeated_phrases.remove_repeats(rows, block=20_000, bucket=2_000, shard=50).collect()
    assert sorted([(r.doc_id, r.n_words, r.kept) for r in found], key=repr) == kept_words(texts)


def test_repeats_of_a_shorter_width_and_of_nothing(spark, docs):
    short = docs.where("length(text) < 2000")
    found = repeated_phrases.remove_repeats(short, width=3, block=900).collect()
    assert sorted([(r.doc_id, r.n_words, r.kept) for r in found], key=repr) == kept_words([(r.doc_id, r.text) for r in short.select("doc_id", "text").collect()], 3)
    assert repeated_phrases.remove_repeats(docs.limit(0)).count() == 0


def test_keys_and_owners_packed():
    r = np.random.default_rng(1)
    for buckets in (1, 7, 4096):
        keys = np.unique(r.integers(0, 2**64, 3000, dtype=np.uint64))
        at = repeated_phrases.bucket_of(keys, buckets)
        for b in np.unique(at):
            mine = keys[at == b]
            assert (repeated_phrases.unpack_keys(repeated_phrases.pack_keys(mine, int(b), buckets), len(mine), int(b), buckets) == mine).all()
    for ids in ([1, 2, 3, 900, None], [5, 2**31, 2**32], [-(2**53) - 1, 2**53 + 1, 2**63 - 1, None], [7], [None], list(range(2**53, 2**53 + 200))):
        for n in (len(ids), 900):
            owner = np.concatenate([np.arange(len(ids)), r.integers(0, len(ids), n - len(ids))])
            docs, packed = repeated_phrases.pack_owners(ids, owner)
            got, null = repeated_phrases.unpack_owners(pa.array(docs, pa.int64()), packed, n)
            assert [None if z else int(v) for v, z in zip(got, null)] == [ids[o] for o in owner]


# Importance draw


def features(text, n):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[p:p + k]) for k in range(1, n + 1) for p in range(len(words) - k + 1)]


@pytest.mark.parametrize("ngrams,block", [(1, 4 << 20), (2, 300), (3, 1)])
def test_gains_and_weights_equal_brute_force(spark, docs, ngrams, block):
    items = [(1, prose(40, 2)), (2, None), (None, "É é ABC")]
    target = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    bucket = lambda f: zlib.crc32(f.encode()) % 997
    s = Counter(bucket(f) for _, t in rows for f in features(t, ngrams)[1])
    t = Counter(bucket(f) for _, x in items for f in features(x, ngrams)[1])
    gains = [int(np.floor(1000 * np.log(((t[b] + 1) * (s.total() + 997)) / ((s[b] + 1) * (t.total() + 997))))) for b in range(997)]
    found = importance.gains_of(docs, target, ngrams, 997, block)
    assert found.tolist() == gains
    got = sorted([(r.doc_id, r.n_words, r.n_features, r.weight) for r in importance.weights(docs, found, ngrams, block).collect()], key=repr)
    assert got == sorted([(i, len(features(x, ngrams)[0]), len(features(x, ngrams)[1]), sum(gains[bucket(f)] for f in features(x, ngrams)[1])) for i, x in rows], key=repr)


def test_draw_on_awkward_rows(spark, docs):
    target = spark.createDataFrame([(1, prose(40, 2))], "item_id long, text string")
    rows = docs.where("length(text) < 200000 or text is null")
    same_as_sql(importance.resample(rows, target), importance.SQL, documents=rows, benchmark=target)


def test_draw_among_ties_and_of_nothing(spark):
    rows = spark.createDataFrame([(i % 3, prose(25, 1)) for i in range(60)], "doc_id long, text string").repartition(6)
    none = spark.createDataFrame([], "item_id long, text string")
    same_as_sql(importance.resample(rows, none), importance.SQL, documents=rows, benchmark=none)
    assert importance.resample(rows.limit(0), none).count() == 0


# Ids beyond 2^53 beside nulls, in one partition


ODD = [2**53 + 1, 2**53 + 3, -(2**53) - 1, 2**63 - 1, 2**53 + 5, None, 7]


@pytest.fixture(scope="module")
def odd_docs(spark):
    base = prose(80, 70).split()
    near = [*base[:40], "other", *base[41:]]
    texts = [prose(60, 71), " ".join(base), prose(40, 72), prose(50, 73), " ".join(near), prose(30, 74), None]
    return spark.createDataFrame([(i, t, "en" if k % 2 else "fr", "s", 1) for k, (i, t) in enumerate(zip(ODD, texts))], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)


def ids_of(df, name="doc_id"):
    return sorted([r[0] for r in df.select(name).collect()], key=repr)


def test_large_ids_stay_as_they_are(spark, odd_docs, tmp_path):
    labels = spark.createDataFrame([(i, k % 2, 0) for k, i in enumerate(ODD)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, prose(30, 75))], "item_id long, text string")
    for found in (shingle_join.join(odd_docs), mixing.mix(odd_docs), sharding.shard(odd_docs), rule_ensemble.classify(odd_docs, labels), line_crf.judge(odd_docs, labels),
                  decontaminate.decontaminate(odd_docs, items), language_id.identify(odd_docs), repeated_phrases.remove_repeats(odd_docs), importance.resample(odd_docs, items)):
        assert ids_of(found) == sorted(ODD, key=repr)
    manifest = token_index.write_tokens(odd_docs, str(tmp_path), queries.tokenizer(), shards=1)
    assert ids_of(token_index.read_digests(manifest)) == sorted(ODD, key=repr)
    assert all(len(token_index.fetch(manifest, i)) == 1 for i in ODD if i is not None) and token_index.fetch(manifest, 2**53) == []
    pages = spark.createDataFrame([(i, "http://a.org/x", "<html><body><p>some text</p></body></html>") for i in ODD], "page_id long, url string, html string").coalesce(1)
    assert ids_of(html_wrapper.extract(pages), "page_id") == sorted(ODD, key=repr)
    rules = spark.createDataFrame([("org/", "allow"), ("a.org", "block")], "key string, verdict string")
    assert ids_of(url_filter.judge(pages, rules), "page_id") == sorted(ODD, key=repr)


def test_links_of_large_ids(odd_docs):
    links = {r.doc_id: (r.class_id, r.n_links) for r in shingle_join.join(odd_docs).collect()}
    assert links[2**53 + 3] == links[2**53 + 5] == (2**53 + 3, 1)
    assert ids_of(shingle_join.one_of_each(odd_docs)) == sorted([i for i in ODD if i != 2**53 + 5], key=repr)


# Pages that nest deeply, names that only look closed, and the statistics of the pipeline's first stage


def text_of(page):
    return html_wrapper.read_page(page, html_wrapper.groups_to_read(html_wrapper.wrapper_of(html_wrapper.parse(page))))


def test_pages_nested_deeply(spark):
    assert text_of("<div>" * 100_000 + "deep") == "deep"
    assert text_of("<div>" * 300 + "<nav>" * 300 + "menu" + "</nav>" * 300 + "<p>kept</p>" + "</div>" * 300) == "kept"
    pages = spark.createDataFrame([(1, "http://a.org/", "<div>" * 2_000 + "one"), (2, "http://a.org/b", "<body><article><p>two</p></article></body>")], "page_id long, url string, html string")
    assert [(r.page_id, r.text) for r in html_wrapper.extract(pages).orderBy("page_id").collect()] == [(1, "one"), (2, "two")]


@pytest.mark.parametrize("page,text", [
    ('<body class="no-sidebar"><article><p>one</p></article></body>', "one"), ('<body class="home navbar-fixed"><main><p>two</p></main></body>', "two"),
    ('<body><article class="post comment-open"><p>three</p><section id="related-work"><p>four</p></section><div class="related-posts">five</div></article></body>', "three\nfour"),
    ('<article><div class="site-nav">menu</div><p>a &amp; &<b>amp;</b></p><div class="ad-slot">buy</div></article>', "a & &amp;")])
def test_names_of_groups(page, text):
    assert text_of(page) == text


def test_statistics_of_the_first_stage_are_computed_once(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = rule_ensemble.good_documents(docs, labels)
    scored = rule_ensemble.classify(docs, labels).where("predicted = 1")
    assert ids_of(kept) == ids_of(scored) and kept.columns == docs.columns
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= rule_ensemble.with_statistics(docs, F.struct("*"))._jdf.queryExecution().optimizedPlan().toString().count("split(")
