"""Classifiers by held-out results, host rules and pages against brute force, and the whole pipeline against plain code."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rankloom.llm import host_rules, langid, quality, style_tree, toxicity
from rankloom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    from check import connect

    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    import __spark_entry__  # noqa: F401  registers the queries
    from check import compare

    assert compare(spark, con, "/root/testdata/sf0.001", name) is None


def auc(scores, labels):
    rank = np.argsort(np.argsort(scores)) + 1
    p = labels.sum()
    return (rank[labels == 1].sum() - p * (p + 1) / 2) / (p * (len(labels) - p))


@pytest.mark.parametrize("name,label,least", [("op2_ftrl_toxicity", "toxic", 0.85), ("op3_positive_unlabelled_quality", "quality", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    got = QUERIES[name](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("score", label).collect()
    assert got.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert auc(np.array([r[0] for r in rows]), np.array([r[1] for r in rows])) >= least


def test_held_out_languages(spark):
    got = QUERIES["op5_compression_language_id"](spark, SF_DIR)
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


ODD_DOCS = [(1, "plain words here", "en"), (1, "plain words here", "en"), (None, "other words there", "en"), (2, None, "de"),
            (3, "", None), (4, "  \n ", "de"), (5, "1234 !!", "de"), (6, "wörter und sätze " * 3000, "de"), (7, "die wörter", "de")]


def odd(spark):
    docs = spark.createDataFrame(ODD_DOCS, "doc_id bigint, text string, lang string")
    return docs.withColumns({"h": F.lit("x"), "score": F.lit(1), "kind": F.lit("y"), "label": F.lit("z")})


def test_numbers_are_no_letters(spark):
    known = langid.Dictionaries(["de", "en"], [b"der die das und nicht", b"the and with that not"])
    texts = ["\u00bd \u2461", "\u00b2", "\u2167", "\u0308", "_ 12", "\u00aa", "x", "\u4e2d"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = [r["lang_pred"] for r in langid.identify(rows, known).orderBy("doc_id").collect()]
    assert got[:5] == ["und"] * 5 and "und" not in got[5:]


def test_language_of_odd_texts(spark):
    docs = odd(spark)
    known = langid.learn(docs, F.lit(True))
    assert known.languages == ["de", "en"] or known.languages == ["en", "de"]
    rows = langid.identify(docs, known).collect()
    assert len(rows) == len(ODD_DOCS)
    assert Counter(r["lang_pred"] for r in rows)["und"] == 4
    assert all(0 <= r["score"] <= 1 and (r["lang_pred"] != "und" or r["rejected"]) for r in rows)
    assert langid.accepted(docs, known).columns == docs.columns
    none = langid.learn(docs.where("false"), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_scores_of_odd_texts(spark, module, label):
    docs = odd(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 0), (2, None), (3, 0), (6, 0), (7, 1), (99, 1)], f"doc_id bigint, {label} int")
    for known in (labels, labels.where("false")):
        rows = module.scores(docs, module.fit(docs, known, F.lit(True))).collect()
        assert len(rows) == len(ODD_DOCS) and all(0 <= r["score"] <= 1 for r in rows)
    assert module.scores(docs.where("false"), module.fit(docs.where("false"), labels, F.lit(True))).collect() == []


def test_ftrl_keeps_noise_at_zero():
    rng = random.Random(1)
    model = toxicity.Ftrl(64)
    for _ in range(400):
        label = rng.random() < 0.5
        model.learn(np.array(sorted({rng.randrange(60) for _ in range(6)} | ({60} if label else {61})), dtype=np.int32), int(label))
    w = model.weights(np.arange(64))
    assert w[60] > 0 > w[61] and (w[:60] == 0).mean() > 0.5


def test_risk_is_never_driven_below_zero():
    rng = np.random.default_rng(0)
    good = ["alpha beta gamma. " * int(n) for n in rng.integers(3, 9, 40)]
    bad = ["ALPHA!! $$$ 99 " * int(n) for n in rng.integers(3, 9, 40)]
    positive, mixed = quality._Table(pa.array(good[:20])), quality._Table(pa.array(good[20:] + bad))
    w, b = quality.minimise(positive, mixed, 1 / 3)
    scores = mixed.times(w, b)
    assert auc(scores, np.array([1] * 20 + [0] * 40)) == 1


def test_host_rules(spark):
    rng = random.Random(2)
    line = "a b c d e f g h i j k"
    texts = [line, f"{line}\n{line}", "x y", None, "", " \t\n", "# $ *" + line, "ä ö " * 40, "\x0b".join("abcdefghijk"), f"\n\n{line}\n \n{line} \n{line}"]
    texts += [" ".join(rng.choice("abc" if k % 12 == 0 else "abcdefghijklmnop") for _ in range(rng.randint(0, 60))) for k in range(60)]
    rows = [(i % 50 if i % 9 else None, t, None if i % 8 == 0 else "bad" if i % 3 == 0 or len(t or "") < 9 else f"h{i % 4}") for i, t in enumerate(texts)]
    rows += [(900 + i, "x", "bad") for i in range(60)] + [(1, line, "bad")]

    def features(text):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        wins = defaultdict(list)
        for i in range(len(words) - 4):
            wins[tuple(words[i:i + 5])].append(i)
        covered = {i + k for at in wins.values() if len(at) > 1 for i in at for k in range(5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed

    hosts = defaultdict(list)
    for _, t, h in rows:
        if h is not None:
            hosts[h].append(features(t)[-1])
    rates = [sum(v) / len(v) for v in hosts.values()]
    m, v = np.mean(rates), np.var(rates, ddof=1)
    s = m * (1 - m) / v - 1
    a, b = (m * s, (1 - m) * s) if s > 0 else (1, 1)
    bad = {h for h, x in hosts.items() if (sum(x) + a) / (len(x) + a + b) > host_rules.MAX_HOST_RATE}
    assert bad == {"bad"}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("host", F.lit(0)).withColumn("words", F.lit(1))
    got = host_rules.judge(docs, F.col("source"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == Counter(
        (k, *f, not f[-1] and h not in bad) for k, t, h in rows for f in [features(t)])
    assert host_rules.judge(docs.where("false"), F.col("source")).collect() == []


BAR = "<nav class=menu><ul><li><a href='/'>Home</a><li>News</ul></nav>"
CASES = [
    ("<article><h1>T</h1><p>One &amp; two<br>three\n  four</p><p>&#233;&nbsp;x</article>", "T\n\nOne & two three four\n\né x"),
    (f"<html><head><title>no</title><style>p{{}}</style></head><body>{BAR}<main><p>Yes<script>no('</p>')</script> it is</p></main><footer>c</footer>", "Yes it is"),
    ("<body><header>no</header><aside>no</aside><p>a</p><div class='cookie-notice'>no</div><form>no<input></form><div>b<!-- no --> c</div></body>", "a\n\nb c"),
    ("<article><header><h1>Head</h1></header><p>x</p><section id=comments><p>no</p></section></article>", "Head\n\nx"),
    ("<article><p>a <b>bold</b>ly <i>i</article> after", "a boldly i"),
    ("<div class='content-with-sidebar'><p>kept</p></div><div class='sidebar'>no</div><div role=navigation>no</div>", "kept"),
    ("plain < text &lt;b&gt; 1 < 2", "plain < text <b> 1 < 2"), ("", ""), (None, ""), ("<article></article>", ""), ("<p", ""),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\n\nb\n\nc\n\nd"),
    ("<!-- <article>no</article> --><p>" + "long " * 30000 + "</p>", ("long " * 30000).strip()),
    ("<article><p>Hi <button>Subscribe</button> there <label>Mail</label> <span class=ad>AD</span>x<video>no</video></p></article>", "Hi there x"),
    ("<article><p>a</p><div class='comment-body'><p>no</p></div><div class='post-comments'>no</div><p>b</p></article>", "a\n\nb"),
    ("<body><div class='main-navigation'>no</div><div class='content-sidebar'>no</div><p>a</p><div class='page-footer'>no</div></body>", "a"),
    ("<div class='post-header'><h1>H</h1></div><p>x</p><div class='page-header'>no</div>", "H\n\nx"),
    ("<div>" * 520 + "<nav>no</nav>yes" + "<span>" * 9000 + "</b>" * 9000, "yes"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("</p></div>x<br/><img src='>'>y", "x y"),
]


def test_pages(spark):
    rows = [(i, None if i % 4 == 0 else f"http://Host.example:80/{i}", page) for i, (page, _) in enumerate(CASES)] + [(None, "u", CASES[0][0])] * 2
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("x"))
    want = Counter((i, u, CASES[i or 0][1], len(CASES[i or 0][1])) for i, u, _ in rows)
    assert Counter(map(tuple, style_tree.extract(pages).collect())) == want
    assert style_tree.extract(pages.where("false")).collect() == []


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_an_id_with_a_third_of_the_rows(spark, monkeypatch, module, label):
    """The limits hold for rows: copies teach once, and different texts of one id do not come beside them."""
    seen = []
    for name in [n for n in dir(module) if n.startswith("MAX_")]:
        monkeypatch.setattr(module, name, 30)
    texts = [(i, f"good words number {i} here" if i % 2 else f"bad junk {i} $$$") for i in range(60)]
    docs = spark.createDataFrame(texts + [(1, "copy")] * 30 + [(2, f"text {i}") for i in range(30)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], f"doc_id bigint, {label} int")
    options = {"max_rows": 30} if module is toxicity else {}
    once = module.scores(docs, module.fit(docs, labels, F.lit(True), **options)).orderBy("doc_id", "score").collect()
    again = module.scores(docs, module.fit(docs.unionAll(docs.where("text = 'copy'")), labels, F.lit(True), **options)).orderBy("doc_id", "score").collect()
    seen += [r["score"] for r in once]
    assert once == again and len(set(seen)) > 2


def test_template_goes_by_its_importance(spark):
    rng = random.Random(0)

    def page(i):
        body = "".join(f"<p>{' '.join(rng.choices('abcdefgh', k=20))} {i}</p>" for _ in range(rng.randint(2, 9)))
        return f"<body><div class=top0>Shop <span>now</span></div><div class=x>{body}</div><div class=y>All rights</div></body>"

    pages = spark.createDataFrame([(i, "http://a.example/", page(i)) for i in range(60)], "page_id int, url string, html string")
    for r in style_tree.extract(pages).collect():
        assert "Shop" not in r["text"] and "rights" not in r["text"] and r["text"].count(str(r["page_id"])) >= 2


def test_copies_of_an_article_stay(spark):
    same = f"<body>{BAR}<article><p>the very same words</p><p>on every page</p></article></body>"
    pages = spark.createDataFrame([(i, "http://a.example/", same) for i in range(60)], "page_id int, url string, html string")
    assert {r["text"] for r in style_tree.extract(pages).collect()} == {"the very same words\n\non every page"}


def test_pipeline(spark, tmp_path):
    """Each stage against plain code on what the stage before kept."""
    rng = random.Random(4)
    vocabulary = {"en": "the of and with from this that have been not".split(), "de": "der die und mit von das nicht ein wird auf".split()}
    item = "one two three four five six seven eight nine ten eleven"

    def text(lang, n):
        return " ".join(rng.choice(vocabulary[lang]) + rng.choice(["", "s", "n"]) for _ in range(n))

    rows = [(i, text(lang, rng.randint(3, 300)), lang, "s", 0) for i in range(60) for lang in [("en", "de")[i % 2]]]
    rows += [(100 + i, r[1], r[2], "s", 0) for i, r in enumerate(rows[:9])]
    rows += [(200, text("en", 40) + " " + item, "en", "s", 0), (201, rows[0][1] + " password = hunter22 end", "en", "s", 0), (202, None, "en", "s", 0),
             (203, "123", "en", "s", 0), (None, rows[5][1], "de", "s", 0), (7, rows[7][1], "de", "s", 0)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != names[-1]:
            assert docs.columns == schema.replace(",", "").split()[::2]
    first, second, third, fourth, last = (kept[n] for n in names)
    assert {r[0] for r in rows} - {r["doc_id"] for r in first} <= {202, 203} | {
        r[0] for r in rows if r[1] and len(r[1]) < 30} and not {202, 203} & {r["doc_id"] for r in first}

    from tests.llm.test_matching import brute_scan, classes, fingerprint

    label = classes([fingerprint(r["text"]) for r in first], 2)
    assert Counter(r["doc_id"] for r in second) == Counter(
        min((r["doc_id"] for r, k in zip(first, label) if k == g and r["doc_id"] is not None), default=None) for g in set(label))
    assert Counter(map(tuple, third)) == Counter(tuple(r) for r in second if not brute_scan(r["text"], [(1, item)])[1])
    by = {r["doc_id"]: r["text"] for r in third}
    assert {r["doc_id"]: r["text"] for r in fourth} == {k: re.sub("password = hunter22", "[secret]", t) for k, t in by.items()}
    assert any("[secret]" in r["text"] for r in fourth)

    from tests.llm.test_packing_and_resharding import ids_of

    want = {r["doc_id"]: ids_of(r["text"]) + [0] for r in fourth}
    assert {r["doc_id"] for r in last} == set(want)
    for r in last:
        part = want[r["doc_id"]][r["start"]: r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    assert Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "length").collect())) == Counter(
        (r["doc_id"], r["start"], r["length"]) for r in last)


def test_tree_decides_where_no_name_does(spark):
    """The pages with their part elements written as plain elements of neutral classes: the tree alone tells them apart."""
    names = dict(zip("article nav header footer aside main".split(), "abcdef"))

    def neutral(page):
        page = re.sub(r"\s(class|id|role)=(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", page)
        page = re.sub(rf"<({'|'.join(names)})\b[^>]*>", lambda m: f"<div class={names[m[1].lower()]}>", page, flags=re.I)
        return re.sub(rf"</({'|'.join(names)})\s*>", "</div>", page, flags=re.I)

    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()
    plain = {r["page_id"]: Counter(style_tree.main_text(r["html"], None).split("\n\n")) for r in rows}
    made = {r["page_id"]: neutral(r["html"]) for r in rows}
    df = spark.createDataFrame([(r["page_id"], r["url"], made[r["page_id"]]) for r in rows], "page_id bigint, url string, html string")
    got = {r["page_id"]: Counter(r["text"].split("\n\n")) for r in style_tree.extract(df).collect()}
    template = {k: Counter(b.text for b in style_tree.blocks_of(made[k])[0]) - plain[k] for k in plain}
    kept, left = sum((plain[k] & got[k]).total() for k in plain), sum(((got[k] - plain[k]) & template[k]).total() for k in plain)
    assert kept >= 0.95 * sum(c.total() for c in plain.values())
    assert left <= 0.05 * sum(c.total() for c in template.values())
