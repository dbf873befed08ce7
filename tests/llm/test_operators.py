"""Each operator against brute force, held-out accuracy or its law, and odd rows."""

import collections
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from stratamart.llm import (
    decontam,
    html_text,
    lm_score,
    mixing,
    near_dedup,
    pii,
    pivot_search,
    quality,
    queries,
    sharding,
    token_rollup,
)

SMALL = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, class_id long, bag string"
LONG = "word another third fourth fifth " * 6000
ROWS = [
    (1, "one two three four five six seven", "en", "a", 1, 7, 7, 7, "x"),
    (1, "one two three four five six seven", "en", "a", 1, 7, 7, 7, "x"),
    (2, None, "en", "a", None, None, None, None, None),
    (3, "", None, None, 0, 0, 0, 0, ""),
    (4, LONG, "de", "b", 5, 1, 1, 1, "y"),
    (5, " \n\t ", "de", "b", 5, 1, 1, 1, "y"),
    (None, "no id here at all, friend", None, "b", 5, 1, 1, 1, "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    df = queries.queries()[name](spark, SMALL)
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    result = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert check._bag(df.columns, df.collect()) == check._bag(columns, result.fetchall())


# 1: HTML


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<nav>menu</nav>", ""),
        ("<article><h1>T</h1><p>a &amp; <b>b</b>c\n d<p>e<br>f</article><footer>x</footer>", "T a & bc d e f"),
        ('<body><script>var t="</p>";</script><article><p>a<div class="ad">buy</div><form>q</form>'
         '<section id="comments"><p>me</p></section><p>z', "a z"),
        ("<div><div class='sidebar'>links</div><div><p>A long first paragraph of the page.</p>"
         "<p>And another long one, by the same hand.</p></div></div>",
         "A long first paragraph of the page. And another long one, by the same hand."),
        ("<![weird[<article>x</article>", "x"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def paragraphs(name, n):
    return [f"Paragraph {i} {name} " + "with a good deal of running text in it " * 8 + "so it ends." for i in range(n)]


def test_content_chooses_the_regions_on_every_page():
    body, more = paragraphs("one", 4), paragraphs("two", 4)
    p = lambda texts: "".join(f"<p>{x}</p>" for x in texts)
    links = "<ul>" + "<li><a href='/x'>go</a></li>" * 9 + "</ul>"
    teaser = "<article><h3><a href='/y'><b>Read</b></a></h3></article>"
    page = f"<div>{teaser}</div>{links}<div>{p(body)}</div>"
    assert html_text.main_text(page) == " ".join(body)
    page = f"<main><article>{p(body)}</article><article>{p(more)}</article></main>"
    assert html_text.main_text(page) == " ".join(body + more)
    # A tenth of the text in another element, headings and a short end.
    page = (
        f"{links}<div><div><h1>Title</h1>{p(body)}{p(more)}<p>Short end.</p></div></div>{links}"
        f"<div><h2>Part</h2>{p(body[:2])}</div>{links}"
    )
    assert html_text.main_text(page) == " ".join(["Title", *body, *more, "Short end.", "Part", *body[:2]])


def test_every_page_gives_its_article(spark):
    rows = html_text.op1_html_text(spark, SMALL).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", pages[r.page_id], re.DOTALL)[1]
        bare = re.sub(r"</?b>", "", inside)
        parts = [" ".join(__import__("html").unescape(x).split()) for x in re.split(r"<[^>]+>", bare)]
        assert r.text == " ".join(x for x in parts if x) and r.n_chars == len(r.text)


# 2: exact search


def test_search_with_odd_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)]  # copies tie
    rows += [(400, None), (401, [None, 1.0]), (402, [float("nan")] * 6), (403, [math.inf] * 6), (500, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in pivot_search.top_k(df, F.col("vec_id") % 100 == 0, pivots=5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    whole = {}
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i] = [math.floor(1024 * float(np.float32(x))) for x in v] + [0] * (6 - len(v))
    for q in (i for i in whole if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], x, strict=True)), i) for i, x in whole.items() if i != q)
        assert got[q] == [(i, -s) for s, i in scores[:10]]
    assert len(got) == 5


def test_search_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pivot_search.top_k(df, F.lit(True)).count() == 0


# 3: quality


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = quality.op3_quality(spark, folder).join(labels, "doc_id", "left").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    tested = [r for r in rows if r.held_out and r.quality is not None]
    assert sum(r.predicted == r.quality for r in tested) / len(tested) > 0.9


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None)], "doc_id long, quality int")
    model = quality.fit(odd, labels)
    assert {r[0] for r in odd.select(quality.score(model, F.col("text"))).collect()} == {1.0}
    empty = quality.fit(none, labels)
    assert empty.constant == 0.5 and none.select(quality.score(empty, F.col("text"))).count() == 0


# 4: personal data


def test_base_spans_equal_the_plain_patterns():
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def fits(kind, text):
        digits = re.sub("[^0-9]", "", text)
        if kind == "ip":
            return all(int(x) <= 255 for x in text.split("."))
        if kind == "card":
            return 12 <= len(digits) <= 19 and pii.luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    rng = np.random.default_rng(2)
    for alphabet in ("a.@1 2-+()5%é", "1.2 3+-@a00005", "4 5-@ab.c"):
        for _ in range(2000):
            text = "".join(rng.choice(list(alphabet), rng.integers(0, 60)))
            plain = [(m.start(), m.end(), k) for k, p in kinds.items() for m in re.finditer(p, text) if fits(k, m[0])]
            assert pii.base_spans(text) == sorted(plain, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_field_adds_written_out_forms_and_nothing_else(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    weights = pii.trained(docs, 400)
    for text, span, kind in (
        ("write to jo.x at mail7 dot example dot com now", "jo.x at mail7 dot example dot com", "email"),
        ("call (203) 555-8282 today", "(203) 555-8282", "phone"),
        ("host 10[.]0[.]0[.]1 is up", "10[.]0[.]0[.]1", "ip"),
    ):
        added = pii.all_spans(text, weights)[1]
        assert [(text[b:e], k) for b, e, k in added] == [(span, kind)]
    for text in ("", "meet at noon, version 3.1 of 2020-10-11", "a" * 5000 + " 1 " * 500):
        assert pii.all_spans(text, weights) == ([], [])
    odd_texts = spark.createDataFrame([(1, None), (2, ""), (3, "+1 (625) 555-7196")], "doc_id long, text string")
    rows = odd_texts.select("doc_id", pii.detect(F.col("text"), weights).alias("x")).select("doc_id", "x.*").collect()
    assert [(r.n_phone, r.spans) for r in rows] == [(0, ""), (0, ""), (1, "phone:0:17")]


# 5: near duplicates


def overlap(a, b):
    def bag(text):
        words = [w for w in (x.strip(near_dedup.PUNCTUATION) for x in (text or "").lower().split()) if w]
        return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))

    x, y = bag(a), bag(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_signatures_estimate_weighted_overlap():
    rng = np.random.default_rng(3)
    base = [str(x) for x in rng.integers(0, 4, 400)]
    for edits in (10, 60):
        changed = list(base)
        for at in rng.integers(0, 400, edits):
            changed[at] = "q"
        texts = [" ".join(base), " ".join(changed)]
        doc, gram = near_dedup.shingles(texts)
        new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])))
        count = np.diff(np.append(new, len(doc))).astype(float)
        sign = near_dedup.signatures(doc[new], gram[new], count, 2, 4000)
        assert abs((sign[0] == sign[1]).mean() - overlap(*texts)) < 0.04


def test_classes_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    word = lambda i: f"w{i % 97}x{i}"
    chain = [list(map(word, range(120)))]
    for step in range(5):  # each links with the next only
        chain.append([*chain[-1][:]])
        chain[-1][10 + 20 * step] = f"edit{step}"
        chain[-1][15 + 20 * step] = f"more{step}"
    extra = [(9000 + i, " ".join(x)) for i, x in enumerate(chain)]
    texts = {r.doc_id: r.text for r in rows} | dict(extra)
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if overlap(texts[a], texts[b]) >= 0.8:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    both = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = {r.doc_id: r.class_id for r in near_dedup.classes(both).collect()}
    assert got == {i: root(i) for i in texts}


def test_hard_buckets_are_searched_in_full():
    sets = [np.arange(k, k + 100, dtype=np.uint32).tobytes() for k in (0, 15, 5, 300, 305, 900)]
    names = [bytes([i]) for i in range(6)]
    links = near_dedup.bucket_links(names, names, sets, np.zeros(6, int))
    parts = {frozenset(x) for x in links}
    assert len(links) == 3 and frozenset((b"\x03", b"\x04")) in parts


def test_near_duplicates_of_odd_rows(odd, none):
    rows = sorted(((r.doc_id or 0, r.class_id, r.class_size) for r in near_dedup.classes(odd).collect()))
    assert rows == [(0, None, 1), (1, 1, 2), (1, 1, 2), (2, 2, 3), (3, 2, 3), (4, 4, 1), (5, 2, 3)]
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4]
    assert near_dedup.classes(none).count() == 0


def test_one_row_of_each_class_stays_whatever_its_doc_id(spark):
    first, second = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    third, fourth = (" ".join(f"{x}{i}" for i in range(30)) for x in "cd")
    rows = [(7, first, "x"), (7, second, "x"), (8, second, "y"), (7, first, None), (7, first, "x")]
    rows += [(None, third, "x"), (None, third, "y"), (None, third, "x"), (None, fourth, None), (9, fourth, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [tuple(r) for r in near_dedup.keep_one(docs).collect()]
    assert sorted(r[1] for r in kept) == sorted([first, second, third, fourth]) and set(kept) <= set(rows)
    assert {r[1]: r[0] for r in kept} == {first: 7, second: 7, third: None, fourth: 9}
    again = near_dedup.keep_one(docs.repartition(3)).collect()
    assert sorted(map(repr, kept)) == sorted(repr(tuple(r)) for r in again)
    found = near_dedup.classes(docs).collect()
    assert len({(r.class_id, r.class_root) for r in found}) == 4
    assert sorted(r.class_size for r in found) == [2] * 4 + [3] * 6


# 6: mixing


def test_mix_meets_its_targets(spark):
    rows = mixing.op6_mixing(spark, "/root/testdata/sf0.01").collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[(r.source_size, r.target)].append(r)
    for (size, target), of in by.items():
        assert sum(r.size for r in of) == size and target <= 3 * size + 1e-6
        assert all(r.taken <= 3 * r.size for r in of)
        assert abs(sum(r.taken for r in of) - target) <= max(r.size for r in of)
    total = sum(size for size, _ in by)
    assert abs(sum(target for _, target in by) - total) < 1e-6 * total


def test_mix_of_odd_rows(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ROWS) and {r.shard for r in rows} == {7, None, 0, 1}
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0


# 7: decontamination


def test_leaks_are_found_within_the_budget_only():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(words, n))
    items = [(i, decontam.normal(say(40))) for i in range(20)]
    passages = decontam.Passages(items)
    for i, (number, text) in enumerate(items):
        k = int(passages.edits[i])
        changed = list(text)
        for at in rng.integers(0, len(changed), k):
            changed[at] = "z"
        document = say(300) + " " + "".join(changed) + " " + say(200)
        found = passages.leaks(document)
        assert list(found) == [i] and found[i][0] <= k, number
        assert not passages.leaks(say(300) + " " + text[: len(text) // 2] + " " + say(30))
    assert not passages.leaks("") and not passages.leaks("short")
    far = say(200_000) + " " + items[3][1]
    assert list(passages.leaks(far)) == [3]


def test_contamination_equals_containment(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = {r.item_id: decontam.normal(r.text) for r in bench.collect()}
    whole = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in decontam.normal(r.text)}
    got = {(r.doc_id, r.item_id) for r in decontam.contamination(docs, bench).filter("distance = 0").collect()}
    assert got == whole and whole
    kept = {r.doc_id for r in decontam.clean(docs, bench).collect()}
    assert not kept & {d for d, _ in whole}


def test_decontamination_of_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "word another third fourth fifth " * 4)], "item_id long, text string")
    assert [r.doc_id for r in decontam.contamination(odd, bench).collect()] == [4]
    assert decontam.clean(odd, bench).count() == len(ROWS) - 1
    assert decontam.clean(odd, bench.limit(0)).count() == len(ROWS)
    assert decontam.contamination(none, bench).count() == 0


# 8: sharding


def test_shards_grow_into_the_new_one_only(spark):
    rows = sharding.op8_sharding(spark, SMALL).collect()
    assert all(r.grown_shard in (r.shard, 16) for r in rows)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_weighted_shards_and_odd_rows(spark, odd, none):
    ids = spark.range(20000).select(F.col("id").alias("doc_id"))
    counts = {r["__shard"]: r["count"] for r in sharding.shard(ids, weights=(1.0, 3.0)).groupBy("__shard").count().collect()}
    assert abs(counts[1] / 20000 - 0.75) < 0.02
    placed = sharding.shard(odd).collect()
    assert len(placed) == len(ROWS) and {r.shard for r in placed} == {7, None, 0, 1}
    assert sharding.shard(none).count() == 0


# 9: token counts


def test_rollup_equals_a_recount(spark):
    encoder = token_rollup.encoding(token_rollup.sent(spark).value)
    seen, sums = set(), collections.Counter()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect():
        if r.text not in seen:
            seen.add(r.text)
            sums[(r.source, r.lang)] += len(encoder.encode_ordinary(r.text))
    rows = token_rollup.op9_token_rollup(spark, SMALL).collect()
    assert {(r.source, r.lang): r.n_tokens for r in rows} == dict(sums)
    assert sum(r.n_docs for r in rows) == len(seen)


def test_rollup_gives_totals_of_all_rows_too(spark, tmp_path):
    rows = [(1, "a b", "en", "x"), (1, "a b", "en", "x"), (None, "a b", "en", "y"), (None, "c  d e", None, "y")]
    rows += [(None, "c  d e", None, "y"), (5, None, "de", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    encoder = token_rollup.encoding(token_rollup.sent(spark).value)
    count = {"byte_bpe_50k": lambda t: len(encoder.encode_ordinary(t)), "white-space": lambda t: len(t.split())}
    expected = collections.defaultdict(lambda: (0, 0, 0))
    for _, text, lang, source in rows:
        for version, tokens in count.items():
            docs, chars, n = expected[source, lang, version]
            expected[source, lang, version] = (docs + 1, chars + len(text or ""), n + tokens(text or ""))
    got = queries.queries()["token_totals"](spark, str(tmp_path)).collect()
    assert {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_chars, r.n_tokens) for r in got} == expected
    once = token_rollup.op9_token_rollup(spark, str(tmp_path)).collect()
    assert {(r.source, r.lang): r.n_docs for r in once} == {("x", "en"): 1, ("y", None): 1, (None, "de"): 1}


def test_batches_count_once(spark, odd, none):
    rollup = token_rollup.Rollup(spark)
    assert rollup.totals().count() == 0
    rows = token_rollup.counted(odd, "v1", token_rollup.sent(spark))
    rollup.commit("1", token_rollup.signed(rows, 1))
    rollup.commit("1", token_rollup.signed(rows, 1))
    assert sum(r.n_docs for r in rollup.totals().collect()) == len(ROWS)
    rollup.commit("2", token_rollup.revised(rows, rows.withColumn("tokenizer", F.lit("v2"))))
    assert {r.tokenizer for r in rollup.totals().collect()} == {"v2"}
    rollup.commit("3", token_rollup.signed(rows.withColumn("tokenizer", F.lit("v2")), -1))
    rollup.commit("4", token_rollup.signed(token_rollup.counted(none, "v2", token_rollup.sent(spark)), 1))
    assert rollup.totals().count() == 0


# 10: language model


def test_base_scores_equal_brute_force(spark):
    rows = lm_score.op10_lm_score(spark, SMALL).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    counts = collections.Counter()
    for i, text in docs.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update([*lm_score.words_of(text), "end"])
    total, distinct = sum(counts.values()), len(counts)
    assert len(rows) == len(docs)
    for r in rows:
        words = [*lm_score.words_of(docs[r.doc_id]), "end"]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert r.base_score == pytest.approx(base) and r.train_tokens == total
        assert (r.n_tokens, r.n_known) == (len(words), sum(w in counts for w in words))
        assert r.score < 0


def test_model_is_causal_normal_and_scores_each_token_once():
    rng = np.random.default_rng(8)
    of = np.append(rng.integers(0, lm_score.CLASSES - 1, lm_score.PIECES), lm_score.CLASSES - 1)
    inside = np.zeros((lm_score.CLASSES + 1, lm_score.PIECES + 1), np.float32)
    model = lm_score.Attention(of, inside, np.append(of[:-1] % 2 == 0, True))
    x = rng.integers(0, lm_score.CLASSES, (3, 32))
    z, _ = model.forward(x, 0)
    changed = x.copy()
    changed[:, 20:] = 5
    assert np.allclose(model.forward(changed, 0)[0][:, :20], z[:, :20], atol=1e-5)
    ids = np.append(rng.integers(0, lm_score.PIECES, 150), lm_score.END)
    ends = np.array([1, 40, 151])
    tokens, _, begins = model.scores(ids, ends)
    assert (tokens < 0).all() and (begins < 0).all()
    for begin, end in ((0, 1), (1, 40), (40, 151)):  # alone as together
        alone, _, starts = model.scores(ids[begin:end], np.array([end - begin]))
        assert np.allclose(alone, tokens[begin:end], atol=1e-4)
        assert np.allclose(starts, begins[begin:end], atol=1e-4)
    every = 10.0 ** np.stack([model.log_chances(x, np.full_like(x, c), 0)[0] for c in range(lm_score.CLASSES)])
    begin = 10.0 ** model.log_chances(x, x % lm_score.CLASSES, 0)[1]
    starting = model.sides[:, 1] > 0
    assert np.allclose(every[starting].sum(0), 1, atol=1e-4)
    assert np.allclose(every[~starting].sum(0) + begin, 1, atol=1e-4)


def test_frequent_words_and_windows_tell_languages_apart():
    table = {b" a": 0, b" b": 1, b" x": 2, b" y": 3, b"s": 4}
    begins = np.zeros(lm_score.PIECES + 1, bool)
    begins[[0, 1, 2, 3, lm_score.END]] = True
    windows = np.array([[0] * 9 + [100 + i, 200] for i in range(40)] + [[1] * 9 + [150 + i, 300] for i in range(40)])
    of = lm_score.class_of_ids(windows, table, begins)
    assert of[0] != of[1] and len(of) == lm_score.PIECES + 1
    assert not set(of[begins]) & set(of[~begins][of[~begins] >= lm_score.ALONE])
    assert of.max() == of[lm_score.END] == lm_score.CLASSES - 1


def test_language_model_of_odd_rows(odd, none):
    rows = lm_score.score(odd.select("doc_id", "text"), lm_score.crc_of_id() % 5 == 1).collect()
    assert len(rows) == len(ROWS)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 5)} == {1}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert lm_score.score(none.select("doc_id", "text"), F.lit(False)).count() == 0
