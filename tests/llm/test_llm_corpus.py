"""Extraction, mixing, near-duplicates, toxicity, and the pipeline."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ebbtide.llm import minhash, mixing, toxicity, wrappers


def page(i, body, nav="Home About"):
    return f"<html><head><title>t{i}</title><script>var a='</p>';</script></head><body><div id=top><span>{nav}</span></div><div><div>{body}</div><div>Same words everywhere</div></div><footer>foot {i}</footer></body></html>"


def text_of(h):
    return wrappers.main_text(wrappers.parse(h), [], frozenset())


def test_markup_rules():
    h = (
        '<header><h1>Site</h1></header><div class="cookie-notice">We use</div><div class="mainMenu"><a>x</a></div><article><header class="entry-header"><h1>T &amp; x</h1></header>'
        '<p>One <b>bold</b>text<p>Two<div class="ad-banner">AD</div><ul><li>a<li>b</ul><form><input>f</form><section id="comments"><p>c</p></section><p><b>open<br><p>next&nbsp;\n one</article><aside>s</aside><footer>f'
    )
    assert text_of(h) == "T & x One boldtext Two a b open next one"
    assert text_of("") == text_of("<!-- x -->") == "" and text_of("plain &lt; text") == "plain < text"
    assert text_of("<div>" * 5000 + "deep") == "deep" and text_of("a<b") == "a"


def test_names_of_an_article_are_its_own_words():
    own = ['<section id="search-algorithms">a</section>', '<div class="side-by-side">b</div>', '<section id="related-work">c</section>', '<div class="form-factor">d</div>', '<h2 id="comments">e</h2>', '<section id="comments-in-code">f</section>']
    dropped = ['<div class="related-posts">x</div>', '<div id="comments">x</div>', '<div class="user-comments">x</div>', '<div class="share-buttons">x</div>', '<div class="search-results-box"><a>x</a></div>', '<div class="signup-today"><input>x</div>', '<div class="ad-300x250">x</div>', '<div class="my-ad">x</div>']
    assert text_of(f"<article>{''.join(x + y for x, y in zip(own, dropped, strict=False))}{''.join(dropped)}</article>") == "a b c d e f"
    assert text_of(f"<body>{''.join(dropped)}<p>text</p>{own[1]}</body>") == "text"


def test_tree_matching_keeps_order_and_parents():
    a = wrappers.fold(wrappers._elements([wrappers.parse("<div><p>1</p><p>2</p></div><ul><li>x</ul><div class=z><h1>t</h1></div>")]))
    b = wrappers.from_outline(wrappers.outline(wrappers.fold(wrappers._elements([wrappers.parse("<div><p>1</p></div><div class=z><h1>q</h1></div>")]))))
    assert wrappers.match(a, b) == 4
    assert [f.number for f in a] == [0, -1, 2]


def test_constant_nodes_become_template(spark):
    rows = [(i, f"http://h.example/{i}", page(i, f"<p>Article number {i}</p><p>More {i}</p>")) for i in range(6)]
    rows += [(10, "http://alone.example/", page(10, "<p>Alone</p>")), (11, None, None), (12, "nonsense", ""), (0, "http://h.example/0", page(0, "<p>Article number 0</p><p>More 0</p>"))]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, outline string").withColumn("host", F.lit("h")).withColumn("of", F.lit(1))
    assert wrappers.with_main_text(df).columns == ["page_id", "url", "outline", "host", "of", "text"]
    assert {(r.outline, r.host, r.of) for r in wrappers.with_main_text(df).collect()} == {("extra", "h", 1)}
    got = {r.page_id: r.text for r in wrappers.with_main_text(df).collect()}
    assert got[3] == "Article number 3 More 3"
    assert got[10] == "Home About Alone Same words everywhere" and got[11] == got[12] == ""
    assert wrappers.with_main_text(df.limit(0)).count() == 0


def test_long_lists_match_as_short_ones_do(monkeypatch):
    def folds(seed, n):
        rng = random.Random(seed)
        return wrappers.fold(wrappers._elements([wrappers.parse("".join(rng.choice(["<h2>t</h2>", "<p>x</p>", "<ul><li>a</ul>", "<div><h3>q</h3></div>", "<div><p>q</p></div>", "<h4>u</h4>"]) for _ in range(n)))]))

    def numbers(fs):
        return [(f.number, numbers(f.children)) for f in fs]

    found = []
    for cells in (10**9, 20, 4096):
        monkeypatch.setattr(wrappers, "MAX_CELLS", cells)
        a, b = folds(1, 200), wrappers.from_outline(wrappers.outline(folds(2, 220)))
        found.append((wrappers._count(a, b), wrappers.match(a, b), numbers(a)))
    assert found[0] == found[1] == found[2] and found[0][0] == found[0][1]


def test_end_tags_of_deep_elements_close_nothing_else():
    assert text_of("<div><article><p>a" + "<div>" * 900 + "deep" + "</div>" * 900 + "<p>after</article></div>") == "a deep after"


def main_texts(spark, pages):
    df = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in wrappers.with_main_text(df).orderBy("page_id").collect()]


def test_copies_are_no_template(spark):
    others = [page(i, f"<p>Article number {i}</p><p>More {i}</p>") for i in range(4)]
    copied = page(9, "<p>Nine has</p><h2>Its own part</h2><p>And an end</p>")
    made = main_texts(spark, others + [copied] * 5)
    assert made == [f"Article number {i} More {i}" for i in range(4)] + ["Nine has Its own part And an end"] * 5


def test_near_copies_are_no_template(spark):
    words = " ".join(f"w{i}" for i in range(200))
    near = [f"<body><h1>The title</h1><p>{words} {i}</p></body>" for i in range(3)]
    assert main_texts(spark, near) == [f"The title {words} {i}" for i in range(3)]


def test_an_outlier_keeps_the_template(spark):
    pages = [page(i, f"<p>Article number {i}</p>", "Home About" if i else "Moved home") for i in range(20)]
    assert main_texts(spark, pages) == [("" if i else "Moved home ") + f"Article number {i}" for i in range(20)]


def test_alignment_alone_finds_the_text_between_varying_menus(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    pages, want = [], []
    for _ in range(12):
        menu = "".join(f"<li><a href=/{word()}>{word()} {word()}</a></li>" for _ in range(rng.randint(8, 14)))
        title, body = word(), [" ".join(word() for _ in range(40)) for _ in range(rng.randint(2, 5))]
        pages.append(f"<body><div class=x1><ul>{menu}</ul></div><div class=x2>{word()} {word()}</div><div class=x3><h1>{title}</h1>{''.join(f'<p>{b}</p>' for b in body)}</div><div class=x4>{word()}</div></body>")
        want.append(" ".join([title, *body]))
    assert main_texts(spark, pages) == want
    df = spark.createDataFrame([(i, f"http://h.example/{i}", h.replace("<div class=x1>", "<nav>").replace("</ul></div>", "</ul></nav>")) for i, h in enumerate(pages)], "page_id long, url string, html string")
    assert [r.text for r in wrappers.with_main_text(df, names=False).orderBy("page_id").collect()] == want
    alone = df.withColumn("url", F.concat(F.lit("http://h"), "page_id", F.lit(".example/")))
    assert all(r.text != want[r.page_id] for r in wrappers.with_main_text(alone, names=False).collect())


def test_region_holds_the_text_and_not_the_teaser(spark):
    teaser = "<article><h3>Teaser</h3><p>See also</p></article>"
    body = "<div><p>" + "A long body of the page. " * 5 + "</p></div>"
    for tag in ("main", "div"):
        assert "A long body" in text_of(f"<body><{tag}><h1>Title</h1>{body}{teaser}</{tag}></body>")
    assert text_of("<article><div class='post-header'><h1>Title</h1></div><p>Body</p><div class='header'>By us</div></article>") == "Title Body"
    pages = [f"<body><div><i>Day {i}</i></div><div class=c><h1>Title {i}</h1><div><p>{'word ' * 60}{i} is said</p></div></div><article><p>See {i}</p></article></body>" for i in range(5)]
    assert main_texts(spark, pages) == [f"Title {i} {'word ' * 60}{i} is said" for i in range(5)]


def test_water_filling(spark):
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate([("a", 5)] * 20 + [("b", 50)] * 40 + [("c", 30)] * 60 + [(None, 10)] * 30 + [("d", 0)] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    plan = mixing.plan(docs).toPandas()
    sizes = {"a": 100, "b": 2000, "c": 1800, "": 300, "d": 0}
    weights = dict(zip(["a", "b", "c", "d", ""], [5, 2, 1, 5, 2]))
    targets, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while True:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if weights[s] * level > 2 * sizes[s]}
        if not over:
            targets |= {s: weights[s] * level for s in free}
            break
        targets |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    for s, g in plan.fillna({"source": ""}).groupby("source"):
        assert abs(g.target.iloc[0] - targets[s]) < 1e-6
        taken = (g["copies"] * g["size"]).sum()
        assert abs(taken - targets[s]) <= max(g["size"].max() / 2 + 1e-9, 0)
        assert g["copies"].max() <= 2
    again = mixing.plan(docs).toPandas()
    assert plan.sort_values("key").reset_index(drop=True).equals(again.sort_values("key").reset_index(drop=True))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == plan["copies"].sum()
    assert mixing.mix(docs.limit(0)).count() == 0
    single = mixing.plan(docs.where("doc_id = 0")).first()
    assert single["copies"] in (1, 2)


def test_equal_rows_are_sampled_each(spark):
    rows = [(7, "same", "w " * 13, "en")] * 200 + [(i, f"s{i:02d}", "w " * (20 + i), "en") for i in range(1, 28)] + [(1, "s01", "w " * 21, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, copies string")
    plan = mixing.plan(docs).toPandas()
    assert len(plan) == len(rows)
    for _, g in plan.groupby("source"):
        assert abs((g["copies"] * g["size"]).sum() - g.target.iloc[0]) <= g["size"].min() / 2 + 1e-9 and g["copies"].max() <= 2
    by_name = mixing.plan(docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")))
    assert by_name.groupBy("source").agg(F.sum(F.col("copies") * F.col("size"))).count() == 28 and by_name.where("key not like 'd%' or key is null").count() == 0
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == plan["copies"].sum()
    assert mixed.where("source = 'same'").count() == plan[plan.source == "same"]["copies"].sum()


def test_many_sources_are_lined_up(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.format_string("s%04d", F.col("id")).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"))
    plan = mixing.plan(docs).toPandas().sort_values("source")
    sizes, weights = plan["size"].to_numpy(float), np.resize([5.0, 2.0, 1.0], len(plan))
    low, high = 0.0, 1e6
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if np.minimum(2 * sizes, weights * middle).sum() < 1.5 * sizes.sum() else (low, middle)
    assert np.allclose(plan.target, np.minimum(2 * sizes, weights * high))


def brute(docs):
    sets = {}
    for i, t in docs:
        if i is not None:
            sets[i] = sets.get(i, set()) | minhash.shingle_set(t)
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = label[a], label[b]
                label = {i: min(x, y) if v in (x, y) else v for i, v in label.items()}
    return label


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    docs = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "ONE  two"), (5, "one two three four five"), (None, "one two")]
    base = [rng.choice(words) for _ in range(60)]
    for i in range(6, 90):  # one large group of near copies, with different amounts of change
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(60)] = rng.choice(words)
        docs.append((i, " ".join(copy)))
    for i in range(90, 130):
        docs.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(4, 30))) + (" " + " ".join(base[:30]) if i % 2 else "")))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.kept, r.n_shingles) for r in minhash.clustered(df).collect()}
    want = brute(docs)
    for i, t in docs:
        if i is not None:
            assert got[i] == (want[i], want[i] == i, len(minhash.shingle_set(t))), i
    assert got[None][:2] == (None, True)
    kept = minhash.deduplicated(df.withColumn("a", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "a"] and kept.count() == sum(want[i] == i for i in want) + 1
    assert minhash.clustered(df.limit(0)).count() == 0


def test_groups_about_the_threshold_send_few_pairs(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    base = [rng.choice(words) for _ in range(200)]
    docs = []
    for i in range(300):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(200)] = rng.choice(words)
        docs.append((i, " ".join(copy)))
    sent = []

    def counted(pairs, texts, confirmed=minhash.confirmed):
        sent.append(pairs.count())
        return confirmed(pairs, texts)

    monkeypatch.setattr(minhash, "confirmed", counted)
    got = {r.doc_id: r.component_id for r in minhash.clustered(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs)
    assert sum(sent) < 10 * len(docs), sent


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (50, 100)]
    got = {r.id: r.label for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 50 for i in (50, 100, 101, 102))


@pytest.fixture(scope="module")
def toxic_tables(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + rng.choice("aeiou") for _ in range(rng.randint(5, 60))]
        bad = i % 5 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["Vile!", "horrid", "xarrgh" + rng.choice("aeiou")])
        rows.append((i, " ".join(words), "en" if i % 2 else "de", f"s{i % 4}", 1))
        labels.append((i, 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark, toxic_tables):
    docs, labels = toxic_tables
    model = toxicity.fitted(docs, labels)
    rows = toxicity.with_scores(docs, model).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    assert np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in rows]) > 0.97
    odd = spark.createDataFrame([(1, None, None, None), (2, "", "xx", 0.5), (3, "vile " * 30000, "en", 0.1)], "doc_id long, text string, lang string, score double")
    scored = {r.doc_id: r for r in toxicity.with_scores(odd, model).collect()}
    assert scored[1].score == scored[2].score and scored[3].flagged and scored[1].lang_threshold == 0.5
    assert toxicity.with_scores(docs.limit(0), model).count() == 0


def test_toxicity_learns_from_every_labelled_row(spark):
    ids = spark.range(10400).select(F.col("id").alias("doc_id")).where(~toxicity.held_out(F.col("doc_id")))
    order = [r.doc_id for r in ids.orderBy(F.xxhash64(F.lit(toxicity.SEED), "doc_id")).collect()]
    late = set(order[8000:])  # a word that only these rows hold
    rows = [(i, f"{'blasted' if i in late else 'vile' if i % 10 == 0 else 'fair'} alpha word{i % 50}", "en", int(i in late or i % 10 == 0)) for i in order]
    all_rows = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.fitted(all_rows.drop("toxic"), all_rows.select("doc_id", "toxic"))
    asked = spark.createDataFrame([(1, "blasted alpha word1", "en"), (2, "vile alpha word1", "en"), (3, "fair alpha word1", "en")], "doc_id long, text string, lang string")
    assert {r.doc_id: r.score >= 0.5 for r in toxicity.with_scores(asked, model).collect()} == {1: True, 2: True, 3: False}
    small = toxicity.fitted(all_rows.drop("toxic"), all_rows.select("doc_id", "toxic"), shard_rows=1500)  # many shards, the same answers
    assert {r.doc_id: r.score >= 0.5 for r in toxicity.with_scores(asked, small).collect()} == {1: True, 2: True, 3: False}


def test_toxicity_moves_labelled_texts_once(spark, monkeypatch):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat(F.lit("word"), F.col("id").cast("string")).alias("text"))
    docs = docs.union(docs.where("doc_id = 41 OR doc_id = 1999")).union(spark.createDataFrame([(None, "en", "lost")], "doc_id long, lang string, text string"))
    labels = spark.range(0, 8000, 50).select((F.col("id") + 41).alias("doc_id"), (F.col("id") % 100 == 0).cast("int").alias("toxic"))
    sent, whole = [], toxicity.buckets_of

    def seen(df, *args):
        sent.append(df)
        return whole(df, *args)

    monkeypatch.setattr(toxicity, "buckets_of", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with labels too many to broadcast
    try:
        toxicity.fitted(docs, labels, shard_rows=20, epochs=1)
        plan = sent[0]._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"\) Exchange\nInput \[\d+\]: \[[^\]]*\btext#", plan)) == 1
    wanted = docs.join(labels, "doc_id").where(~toxicity.held_out(F.col("doc_id"))).select("text", "toxic").collect()
    assert sorted((r.text, r.toxic) for r in sent[0].collect()) == sorted(tuple(r) for r in wanted)
    passed = {r.doc_id for r in toxicity._marked(docs, labels, labels.count()).collect()}
    assert {i for i in range(41, 4000, 50)} <= passed and len(passed) < 400


def test_toxicity_without_labels(spark, toxic_tables):
    docs, labels = toxic_tables
    assert {r.score for r in toxicity.with_scores(docs.limit(3), toxicity.fitted(docs, labels.limit(0))).collect()} == {0.5}
    clean = toxicity.fitted(docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.with_scores(docs.limit(3), clean).collect()} == {0.0}


def test_pipeline(spark, toxic_tables, tmp_path):
    docs, labels = toxic_tables
    more = docs.unionByName(docs.limit(40).withColumn("doc_id", F.col("doc_id") + 5000))
    more = more.unionByName(spark.createDataFrame([(9000, "my token = abcdefghijkl0123 " + "alphaa betae " * 9, "en", "s1", 3)], docs.schema))
    more.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, str(tmp_path))
        seen[name] = {r.doc_id for r in out.select("doc_id").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        if name == "secrets":
            assert "[SECRET]" in out.where("doc_id = 9000").first().text
    assert len(seen["toxicity"]) < 800 and not {i for i in seen["near_copies"] if 5000 <= i < 9000}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= len(seen["bpe"])
