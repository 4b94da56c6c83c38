"""The operators against SQL or brute force on awkward rows: nulls, empty and long texts, repeats, ties, clashing names."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from promolens.llm import (decontaminate, html_wrapper, language_id, line_crf, mixing, queries, rule_ensemble, sharding, shingle_join, token_index,
                           url_filter)
from promolens.session import Workspace

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, w string, size string, mark string, row string, key string, h string"
rng = random.Random(5)
VOCABULARY = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def awkward_rows():
    long = prose(6_000, 1)
    base = prose(120, 2)
    near = base.split()
    near[60] = "changed"
    texts = [
        (1, None), (2, ""), (3, " \t\n\x0b "), (4, "one two three"), (5, "one two three"), (6, long), (7, base), (8, " ".join(near)), (9, base), (9, base), (None, base),
        (None, None), (10, "Ünïcode É é \u00a0 x\u2003y %$# 12345 !!"), (11, prose(40, 3) + "\n" + prose(40, 4)), (12, "\n\n" + prose(30, 4) + "\n\n"), (13, "a\x00b c\x1fd e\x85f " + prose(20, 6)),
        (14, "the same line\nthe same line\nthe same line\nother " + prose(12, 7)), (15, "word " * 50), (16, "😀 emoji 😀 words " + prose(20, 8)), (17, "É".join("abc") + " ABC Abc"), (-5, prose(25, 9)), (2**62, prose(25, 9) + " end"),
    ]
    sources = ["a", "b", None, "", "é", "a", "a"]
    return [(i, t, "en" if k % 3 else "fr" if k % 2 else None, sources[k % len(sources)], 7, "w", "s", "m", "r", "k", "h") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(awkward_rows(), DOCS).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, prose(120, 2)[:400]), (2, "one TWO three"), (3, None), (4, ""), (None, prose(40, 3)), (5, prose(40, 3)), (5, prose(40, 3)), (6, prose(6_000, 1)[5000:5600])]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(4, 17)] + [(None, 1, 0), (7, None, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")


def rows_of(frame):
    cols = sorted(frame.columns)
    values = [tuple(None if not isinstance(v, (list, np.ndarray)) and pd.isna(v) else v if isinstance(v, (str, bool, np.bool_)) else float(v) for v in r) for r in frame[cols].itertuples(index=False, name=None)]
    return cols, sorted(values, key=repr)


def same_as_sql(result, sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(f"{name}_pandas", df.toPandas().astype({c: "Int64" for c, t in df.dtypes if t in ("bigint", "int")}))
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_pandas")
    assert rows_of(result.toPandas()) == rows_of(con.execute(sql).df())


def at_sf(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert rows_of(queries.QUERIES[name](spark, SF).toPandas()) == rows_of(con.execute(queries.SQL[name]).df())


def test_join_on_awkward_rows(docs):
    same_as_sql(shingle_join.join(docs), shingle_join.SQL, documents=docs)


def test_join_in_tiles_and_deep_paths_finds_the_same(spark):
    texts = [prose(60, 100)]
    for i in range(60):
        words = texts[0].split()
        words[i] = f"x{i}"
        texts.append(" ".join(words))
    texts += [prose(60, 200 + i) for i in range(40)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    same_as_sql(shingle_join.join(rows, leaf=8, tile=16), shingle_join.SQL, documents=rows)


def test_join_loses_no_more_than_it_says():
    r = np.random.default_rng(4)
    a = r.integers(0, 2**32, 64, dtype=np.uint32)
    b = a.copy()
    b[:29] += np.uint32(1)  # 35 of 64 equal: one pair of 240,000 at the threshold
    rows = pd.DataFrame({"path": 1, "tile": 0, "side": 2, "rep": [3, 8], "sketch": [a.tobytes(), b.tobytes()]})
    stars = pd.concat(shingle_join._leaf_stars(0.8, 0.99999)(iter([rows])))
    assert stars.values.tolist() == [[8, 3]]
    for threshold, recall in ((0.8, 0.99999), (0.5, 0.999), (0.9, 0.999999)):
        least, runs = shingle_join.least_equal(threshold, recall), shingle_join.runs_needed(threshold, recall)
        equal = r.binomial(64, threshold, 2_000_000)
        assert (equal < least).mean() < (1 - recall) / 10
        assert shingle_join.pair_loss(threshold, recall, runs) <= 1 - recall < shingle_join.pair_loss(threshold, recall, runs - 1)


def test_one_of_each_keeps_one_row_of_a_class(docs):
    left = shingle_join.one_of_each(docs)
    assert left.columns == docs.columns
    ids = Counter(r.doc_id for r in left.collect())
    assert ids[9] == 0 and ids[8] == 0 and ids[5] == 0 and ids[4] == 1 and ids[1] == ids[2] == ids[3] == 1
    # The class of 7, 8, 9, 9 and None is left as the row without a doc_id, which sorts first; the other None is wordless.
    assert ids[None] == 2 and ids[7] == 0


def test_mix_on_awkward_rows(docs):
    same_as_sql(mixing.mix(docs), mixing.SQL, documents=docs)


def test_mix_meets_targets_and_repeats_rows(spark):
    docs = at_sf(spark, "documents")
    taken = mixing.mix(docs).toPandas()
    assert (taken.taken <= 2 * taken["size"]).all()
    off = (taken.groupby("source_size").taken.sum() - taken.groupby("source_size").target.first()).abs()
    assert (off <= taken["size"].max() / 2 + 1).all()
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    count = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert all(count[r.doc_id] == r.taken // r.size for r in taken.astype(object).itertuples() if r.size)


def test_water_fill_clamps_and_reshares(spark):
    rows = spark.createDataFrame([("a", 10, 5.0), ("b", 1000, 1.0), ("c", 1000, 1.0), ("d", 0, 2.0)], "source string, source_size long, weight double")
    target = {r.source: r.target for r in mixing.water_fill(rows, 1.0, 2).collect()}
    assert target == {"a": 20.0, "b": 995.0, "c": 995.0, "d": 0.0}


def main_text_of(page):
    w = html_wrapper.wrapper_of(html_wrapper.parse(page))
    return html_wrapper.read_page(page, html_wrapper.groups_to_read(w))


def test_wrapper_reads_the_article_only(spark):
    template = ('<!DOCTYPE html><html><head><title>t {i}</title><style>p{{}}</style><script>var t="</p>";</script></head><body><header><h2>Site</h2></header><nav><ul><li><a href="/x">X</a></li></ul></nav>'
                '<div class="cookie-notice">Cookies {i}</div><article><h1>Head &amp; {i}</h1><p>One  <b>bold\n</b> word<p>Two &lt;x&gt; {i}{extra}<div class="ad">Buy</div><ul><li>L1<li>L2</ul>'
                '<form><input name="q">Go</form><section class="comments"><p>Nice</p></section></article><aside>Side</aside><footer>&copy;</footer>')
    pages = [(i, f"http://H.example.org/{i}", template.format(i=i, extra="<p>More" * (i % 3)), "x") for i in range(9)]
    pages += [(20, "http://other.example.org/", "<body><div class='menu'>m</div><div id=content><h1>A</h1>B<p>C</div></body>", "x"), (21, None, None, "x"), (22, "http://other.example.org/2", "", "x"), (22, "", "plain &eacute; text", "x")]
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string, groups string")).collect()}
    for i in range(9):
        lines = [f"Head & {i}", "One bold word", f"Two <x> {i}", *["More"] * (i % 3), "L1", "L2"]
        assert got[(i, f"http://H.example.org/{i}")][0] == "\n".join(lines)
    assert got[(20, "http://other.example.org/")] == ("A\nB\nC", 5) and got[(21, None)] == ("", 0) and got[(22, "")] == ("plain é text", 12)
    assert html_wrapper.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_wrapper_chooses_the_kind_of_group_per_page(spark):
    kinds = ["<article><p>{}</p></article>", "<main><p>{}</p></main>", "<div class=content><p>{}</p></div>", "<p>{}</p>", "<article></article><main><p>{}</p></main>"]
    pages = [(i, host, "<html><body><nav>Menu</nav>" + kinds[i % 5].format(f"text {i}") + "<footer>f</footer></body></html>") for i in range(20) for host in ("http://two.example.org/", None)]
    got = html_wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(got) == 40 and all(r.text == f"text {r.page_id}" for r in got)


def test_wrapper_leaves_out_template_texts_by_their_place(spark):
    bodies = {"hr": ["<p>Welcome</p><hr>" + "".join(f"<p>text {i} {k}</p>" for k in range(1 + i % 3)) + "<p><a href=x>Go</a> <a href=y>on</a></p>" for i in range(6)],
              "copies": ["<h1>Title</h1><p>Body</p>"] * 4, "repeats": ["<p>same</p><p>same</p><p>same</p>"],
              "links": [f"<p><a href=x>Link {i}</a></p><h2>Head {i}</h2><p>text {i}</p>" for i in range(4)]}
    pages = [(i, f"http://{h}.org/{i}", f"<html><body>{b}</body></html>") for h, bs in bodies.items() for i, b in enumerate(bs)]
    got = {r.url[7:]: r.text for r in html_wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[f"hr.org/{i}"].startswith("\n".join(f"text {i} {k}" for k in range(1 + i % 3))) and "Welcome" not in got[f"hr.org/{i}"]
    assert all(got[f"copies.org/{i}"] == "Title\nBody" for i in range(4)) and got["repeats.org/0"] == "same\nsame\nsame"
    assert all(got[f"links.org/{i}"] == f"Head {i}\ntext {i}" for i in range(4))


def test_wrapper_is_a_union_free_expression():
    a, b = ("<body><h1>x</h1><p>1</p><p>2</p></body>", "<body><h1>x</h1><div>n</div><p>3</p></body>")
    w = html_wrapper.merge(*[html_wrapper.wrapper_of(html_wrapper.parse(p)) for p in (a, b)])
    assert html_wrapper.as_expression(w) == "<><body><h1>x</h1>(<div>n</div>)?(<p>#TEXT</p>)+</body></>"


def test_wrapper_equals_the_article_of_all_pages(spark):
    import html as h
    import re

    for r in queries.op3_html_wrapper(spark, SF).join(at_sf(spark, "pages").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(h.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(b for b in blocks if b)


def test_url_filter_on_awkward_rows(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/ES/x", "http://example.org/es/a?b#c", "https://a.example.org/en/1", "http://example.org/en/1x", "http://example.org", "x://com/fr/", "http://x.com/de/#?",
            "http://spam-farm.example.net/a", "http://m.spam-farm.example.net:80/a", "http://spam-farm.example.org/a", "http://.org/a", "http://a..com/fr/1", "http://xcom/fr/", "a://b://org/c", "http://é.com/fr/é?x"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls + urls)], "page_id long, url string, keys string")
    entries = spark.createDataFrame(url_filter.RULES + [(h, "block") for h in url_filter.BLOCKED] + [(None, "block")], "key string, verdict string")
    for blocks in (10_000_000, 5):
        same_as_sql(url_filter.judge(pages, entries, block_keys=blocks), url_filter.SQL, pages=pages)
    assert {r.verdict for r in url_filter.judge(pages, entries.limit(0)).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), entries).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("h1"), F.xxhash64("id", F.lit(1)).alias("h2"), (F.col("id") % 23 == 0).alias("listed"))
    levels = url_filter.build_cascade(keys, Workspace(spark), "t")
    pdf = keys.toPandas()
    assert (url_filter.in_cascade(levels, pdf[["h1", "h2"]].to_numpy(np.int64).view(np.uint64)) == pdf.listed).all() and len(levels) > 2


def test_shards_on_awkward_rows(docs):
    same_as_sql(sharding.shard(docs), sharding.SQL, documents=docs)


def test_overfull_ranges_are_divided(spark):
    docs = at_sf(spark, "documents").select("doc_id", "text").unionByName(spark.range(1000, 1300).select(F.col("id").alias("doc_id"), F.lit("copy " * 60).alias("text")))
    same_as_sql(sharding.shard(docs, sample=64, ranges=8, exact_rows=20, slot_rows=5), sharding.SQL, documents=docs)


def test_rules_hold_out_and_judge(spark, docs, labels):
    out = queries.op6_rule_ensemble(spark, "/root/testdata/sf0.01").toPandas().merge(pd.read_parquet("/root/testdata/sf0.01/labels.parquet"), on="doc_id")
    held = out[out.held_out]
    assert len(out) == 399 and (held.predicted == held.quality).mean() > 0.97 and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    odd = rule_ensemble.classify(docs, labels).toPandas()
    assert len(odd) == docs.count() and odd.score.notna().all() and not odd[odd.doc_id.isna()].held_out.any()
    assert set(rule_ensemble.classify(docs, labels.limit(0)).toPandas().score) == {0.5}
    assert rule_ensemble.classify(docs.limit(0), labels).count() == 0


def test_compiled_rules_filter_like_scores(spark):
    docs, labels = at_sf(spark, "documents"), at_sf(spark, "labels")
    kept = rule_ensemble.good_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rule_ensemble.classify(docs, labels).where("predicted = 1").collect()}


def test_tree_rules_are_paths():
    printed = "T\n  If (feature 0 <= 1.5)\n   Predict: 0.0\n  Else (feature 0 > 1.5)\n   If (feature 1 <= 0.25)\n    Predict: 0.0\n   Else (feature 1 > 0.25)\n    Predict: 1.0\n"
    a, b = rule_ensemble.STATISTICS[:2]
    assert rule_ensemble.tree_rules(printed) == [((a, "<=", 1.5),), ((a, ">", 1.5),), ((a, ">", 1.5), (b, "<=", 0.25)), ((a, ">", 1.5), (b, ">", 0.25))]


def test_tokens_round_trip(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer())
    for rows, parts, cache in ((docs, 3, 50), (at_sf(spark, "documents"), None, 400_000)):
        manifest = token_index.write_tokens(rows, token_index.folder_for(spark), queries.tokenizer(), shards=parts, cache=cache)
        got = token_index.read_digests(manifest).toPandas()
        want, start = [], 0
        ordered = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()
        ids = [tokenizer.encode(r.text, add_special_tokens=False).ids + [2] for r in ordered]
        for r, x in zip(ordered, ids):
            want.append((r.doc_id, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
            start += len(x)
        assert rows_of(got) == rows_of(pd.DataFrame(want, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"}))
        for key in (9, -5, 123456789):
            assert sorted(x.tolist() for x in token_index.fetch(manifest, key)) == sorted(x for r, x in zip(ordered, ids) if r.doc_id == key)
    assert token_index.read_digests(token_index.write_tokens(docs.limit(0), token_index.folder_for(spark), queries.tokenizer())).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(3).integers(-(2**62), 2**62, 50_000))
    slots = token_index.PerfectHash.build(keys).slots(keys)
    assert sorted(slots) == list(range(len(keys))) and len(token_index.PerfectHash.build(keys[:0]).bits) == 0


def brute_base(text):
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text or "").split(" ") if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            hit |= set(range(i, i + 5))
    lines, dup, seen = (text or "").split("\n"), 0, set()
    for line in lines:
        if line.strip(" \t\n\v\f\r"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit), len(words) < 10 or 100 * len(hit) > 20 * len(words)


def test_line_rules_equal_brute_force(spark, docs, labels):
    for rows, known in ((docs, labels), (at_sf(spark, "documents"), at_sf(spark, "labels")), (docs, labels.limit(0))):
        got = line_crf.judge(rows, known).toPandas()
        cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        assert Counter(got[cols].itertuples(index=False, name=None)) == Counter(brute_base(r.text) for r in rows.collect())
        assert not (got.kept & got.base_failed).any()
    assert line_crf.judge(docs.limit(0), labels).count() == 0


def test_line_field_separates_good_and_bad(spark):
    out = queries.op8_line_crf(spark, "/root/testdata/sf0.01").toPandas().merge(pd.read_parquet("/root/testdata/sf0.01/labels.parquet"), on="doc_id")
    rest = out[~out.base_failed]
    assert (rest.kept == (rest.quality == 1)).mean() > 0.97


def test_viterbi_equals_all_paths():
    from itertools import product

    r = np.random.default_rng(1)
    for n in (1, 2, 5, 8):
        e, pair = r.normal(size=(n, 2)), r.normal(size=(2, 2))
        total = lambda y: sum(e[i, k] for i, k in enumerate(y)) + sum(pair[a, b] for a, b in zip(y, y[1:]))  # noqa: E731, B023
        assert tuple(line_crf.viterbi(e.tolist(), pair.tolist())) == max(product((0, 1), repeat=n), key=total)


def test_decontaminate_on_awkward_rows(docs, benchmark):
    sql = decontaminate.SQL
    for block in (20_000, 3):
        same_as_sql(decontaminate.decontaminate(docs, benchmark, block=block), sql, documents=docs, benchmark=benchmark)
    same_as_sql(decontaminate.decontaminate(docs, benchmark.limit(0)), sql, documents=docs, benchmark=benchmark.limit(0))
    assert decontaminate.decontaminate(docs.limit(0), benchmark).count() == 0
    bad = {r.doc_id for r in decontaminate.decontaminate(docs, benchmark).where("contaminated").collect()}
    clean = decontaminate.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == docs.where(~F.coalesce(F.col("doc_id").isin(*[i for i in bad if i is not None]), F.lit(False))).count() - 1


def test_languages_are_told_apart(spark, docs):
    out = queries.op10_language_id(spark, "/root/testdata/sf0.01").toPandas().merge(pd.read_parquet("/root/testdata/sf0.01/documents.parquet"), on="doc_id")
    held = out[out.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98 and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    odd = language_id.identify(docs).toPandas()
    assert len(odd) == docs.count() and set(odd[odd.doc_id.isin([1, 2, 3])].lang_pred) == {"und"} and set(odd.lang_pred) <= {"en", "fr", "und"}
    assert set(language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).toPandas().lang_pred) == {"und"}
    assert language_id.identify(docs.limit(0)).count() == 0


def test_grams_equal_brute_force():
    texts = ["Ab, c1é  d", "", "123", "😀x", "nul\0inside", "z"]
    for t, _ in zip(texts, range(9)):
        low = "".join(c if c.isalpha() or ord(c) > 0xFFFF else " " for c in t.lower())
        runs = "".join(c for i, c in enumerate(low) if c != " " or i == 0 or low[i - 1] != " ")
        want = []
        if runs.strip():
            padded = "   " + runs
            want = [sum(min(ord(c), 0xFFFF) << 16 * (3 - k) for k, c in enumerate(padded[i : i + 4])) for i in range(len(runs))]
        grams, n = language_id.grams_of([t])
        assert grams.tolist() == want and n.tolist() == [len(want)]
    assert language_id.grams_of(texts)[1].tolist() == [len(language_id.grams_of([t])[0]) for t in texts]


def test_most_frequent_grams_are_kept(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 5 < 4, "a").otherwise("b").alias("lang"), F.col("id").alias("gram"), F.when(F.col("id") < 100, 9).otherwise(1).cast("long").alias("n"))
    kept = language_id.most_frequent(rows, 500).toPandas()
    assert (kept.groupby("lang").size() <= 500).all() and (kept.groupby("lang").size() > 450).all() and (kept.n == 9).sum() == 100


def test_all_grams_stay_in_a_model_of_blocks(spark):
    docs = at_sf(spark, "documents")
    whole, blocks = (language_id.identify(docs, max_grams=n).toPandas().sort_values("doc_id", ignore_index=True) for n in (2_000_000, 4_000))
    pd.testing.assert_frame_equal(whole, blocks, rtol=1e-5, atol=1e-7)


def test_emoji_are_no_letters_and_wide_letters_differ(spark):
    grams = lambda t: language_id.letter_grams([t])[0].tolist()
    assert grams("😀 🎉") == [] and grams("ab 😀 c") == grams("ab c") and grams("é中") == language_id.grams_of(["é中"])[0].tolist()
    wide = [chr(c) for c in range(0x10300, 0x10450) if chr(c).isalpha() and chr(c).lower() == chr(c)]
    assert len(wide) > 100 and len({grams(c)[0] for c in wide}) == len(wide)
    r = random.Random(3)
    word = lambda first: "".join(chr(first + r.randrange(20)) for _ in range(40))
    rows = [(i, word(0x10330 if i % 2 else 0x10428), "gothic" if i % 2 else "deseret") for i in range(60)] + [(100, "😀😀 🎉", "gothic")]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).toPandas().set_index("doc_id")
    assert (got.loc[100, "lang_pred"], got.loc[100, "score"]) == ("und", 0) and all(got.loc[i, "lang_pred"] == lang for i, _, lang in rows[:60])


def test_every_language_has_a_limit_from_all_its_texts(spark):
    r = random.Random(8)
    text = lambda letters, n: " ".join("".join(r.choice(letters) for _ in range(5)) for _ in range(n))
    rows = [(i, text("abcdefgh", 6), "many") for i in range(4000)] + [(10_000 + i, text("pqrst", 6), "few") for i in range(12)]
    odd = [(20_000, "rqqqqqqqqtttttttttsqqqqqqqtpppp", "few")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    got = language_id.identify(docs).toPandas().merge(docs.toPandas(), on="doc_id")
    learnt = got[~got.held_out & (got.lang == "many")]
    assert (learnt.lang_pred == "many").all() and 0.008 < learnt.rejected.mean() <= 0.01
    models = language_id.train(docs.where("doc_id <> 20000").select("doc_id", "lang", "text"), 2_000_000, 0.01)
    h, n = models.entropies([t for i, t, lang in rows if lang == "few"])
    few = models.langs.index("few")
    assert np.isfinite(models.limits).all() and h[:, few].max() <= models.limits[few] <= h[:, few].max() + 1 / language_id.BINS


def test_kneser_ney_sums_to_one():
    grams, _ = language_id.grams_of(["the theme then there hath the other"] * 2 + ["that heat"])
    kinds, n = np.unique(grams, return_counts=True)
    letters = np.unique(grams & np.uint64(0xFFFF))
    model = language_id.KneserNey(kinds, n.astype(float), len(letters))
    for context in np.unique(kinds >> np.uint64(16))[:20]:
        p = np.exp(model.log_probability((context << np.uint64(16)) | letters))
        assert abs(p.sum() - 1) < 1e-9


def test_pipeline_stages(spark):
    work, docs = Workspace(spark), at_sf(spark, "documents")
    columns, kept = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, work.keep(stage(spark, docs, SF), f"s{i}")
        kept.append((before, docs))
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    (b, a) = kept[0]
    assert ids(a) == Counter(r.doc_id for r in rule_ensemble.classify(b, at_sf(spark, "labels")).where("predicted = 1").collect())
    (b, a) = kept[1]
    con = duckdb.connect()
    con.register("documents", b.toPandas())
    assert ids(a) == Counter(con.execute(f"SELECT DISTINCT class_id FROM ({shingle_join.SQL})").df().class_id)
    (b, a) = kept[2]
    con = duckdb.connect()
    con.register("documents", b.toPandas())
    con.register("benchmark", at_sf(spark, "benchmark").toPandas())
    assert ids(a) == Counter(con.execute(f"SELECT doc_id FROM ({decontaminate.SQL}) WHERE NOT contaminated").df().doc_id)
    (b, a) = kept[3]
    con = duckdb.connect()
    con.register("documents", b.toPandas())
    assert ids(a) == Counter({int(i): int(n) for i, n in con.execute(f"SELECT doc_id, taken / size FROM ({mixing.SQL}) WHERE taken > 0").fetchall()})
    assert ids(kept[4][1]) == ids(a)
    assert corpus_pipeline.run(spark, SF).count() == a.count()


def test_words_of_any_letters_and_hot_words_stay():
    from tokenizers import Tokenizer

    path = queries.tokenizer()
    tokenizer, words = Tokenizer.from_file(path), token_index.Words(path, 20)
    seen = [*(chr(c) for c in range(0x21, 0x250)), *(f"A{chr(c)}b{chr(c)}" for c in range(0x21, 0x250)), "İx", "ét", "ΟΔΟΣ", "<|endoftext|>", "<|", "it'S", "ÀÉ's,", "9½", "﻿a", "日本語。"]
    for w in seen:
        for part in w.encode().split():
            assert np.frombuffer(words[part], words.kind).tolist() == tokenizer.encode(part.decode(), add_special_tokens=False).ids, repr(w)
    made, whole = [], words.made
    words.made = lambda w: made.append(w) or whole(w)
    for i in range(200):
        words[b"hot"], words[f"w{i}".encode()]
    assert made.count(b"hot") == 1 and len(words) + len(words.older) <= 20
