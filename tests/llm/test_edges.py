"""Nulls, empty and long texts, ties, repeats, empty tables and clashing columns, for every operator."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchgrid.llm import bandjoin, chat, decontaminate, htmlcut, langid, linededup, pieces, quality, shards, topk

LONG = " ".join(f"word{i}" for i in range(3000))
TEXTS = [
    (1, "The house stands by the river\nShort\nThe house stands by the river"),
    (2, "  THE house stands by the river \nanother line of text here"),
    (3, None), (4, ""), (5, "\n"), (6, LONG), (6, LONG), (None, "The house stands by the river"), (7, "☃ 12 ²"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "src", None, 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, key string, word string, chunk int")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_line_dedup(docs, none):
    rows = {(r["doc_id"], r["text"]): r for r in linededup.dedup_lines(docs).collect()}
    assert len(rows) == 8 and linededup.dedup_lines(docs).count() == 9
    assert rows[1, TEXTS[0][1]]["n_dropped"] == 0
    assert rows[2, TEXTS[1][1]]["kept_text"] == "another line of text here"
    assert (rows[3, None]["kept_text"], rows[3, None]["n_lines"]) == ("", 1)
    assert rows[5, "\n"]["n_lines"] == 2
    # A repeated doc_id is one document, so its lines are no repeats; a null id comes last.
    assert rows[6, LONG]["kept_text"] == LONG
    assert rows[None, TEXTS[7][1]]["kept_text"] == ""
    assert linededup.dedup_lines(none).count() == 0


def test_line_dedup_runs(spark):
    many = "\n".join(f"line number {i:05d}" for i in range(500))
    rest = "\n".join(f"line number {i:05d}" if i % 3 else f"own line of it {i}" for i in range(500))
    df = spark.createDataFrame([(1, many), (2, rest)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in linededup.dedup_lines(df).collect()}
    assert got[2]["kept_text"].split("\n") == [f"own line of it {i}" for i in range(0, 500, 3)]
    assert got[2]["n_dropped"] == 500 - len(range(0, 500, 3))


def test_shards(docs, none, tmp_path):
    rows = shards.write_shards(docs, str(tmp_path / "a"), shards=3, bucket_bytes=4000).collect()
    assert len(rows) == len(TEXTS)
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    again = shards.write_shards(docs.repartition(5), str(tmp_path / "b"), shards=3, bucket_bytes=4000).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {1}
    assert sorted(r["text"] or "" for r in rows) == sorted(t or "" for _, t in TEXTS)
    assert shards.write_shards(none, str(tmp_path / "c")).count() == 0


def test_one_more_shard_takes_only_into_itself(spark):
    df = spark.range(5000).withColumn("a", shards.shard_of(F.col("id"), 16, 1)).withColumn("b", shards.shard_of(F.col("id"), 17, 1))
    assert df.where("a <> b AND b <> 16").count() == 0
    assert 150 < df.where("b = 16").count() < 450
    assert sorted(shards.fisher_yates(50, 1, 2, 3)) == list(range(50)) != shards.fisher_yates(50, 1, 2, 3)


def test_chat_trees(spark, none):
    text = "a <| b \\ <\\1 \\0\n<|im_end|>\n<|im_start|>"
    nodes = [
        ("t", 1, None, "user", "root", None), ("t", 2, 1, "assistant", "poor", 0.1), ("t", 3, 1, "assistant", text, 0.9),
        ("t", 4, 3, "us\ner", None, 0.5), ("c", 1, 2, "user", "x", 1.0), ("c", 2, 1, "user", "y", 1.0),
        (None, 9, 8, None, "orphan", 0.0),
    ]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, role string, text string, score double")
    df = df.withColumn("t", F.lit(0)).withColumn("rank", F.lit(0))
    out = chat.format_trees(df, branches=2).select(
        "tree", "rank", "leaf", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss"),
    ).collect()
    got = {(r["tree"], r["rank"]): r for r in out}
    assert set(got) == {("t", 1), ("t", 2), (None, 1)}
    assert [tuple(x) for x in got["t", 1]["turns"]] == [("user", "root"), ("assistant", text), ("us\ner", "")]
    assert got["t", 1]["loss"] == text
    assert [tuple(x) for x in got[None, 1]["turns"]] == [("", "orphan")]
    assert chat.format_trees(df.where("false")).count() == 0


def test_chat_repeated_nodes(spark):
    """Rows that repeat a node are one node, the least of them; a node without an id is none."""
    nodes = [("t", 1, None, "user", "root", 1.0), ("t", 2, 1, "assistant", "reply", 0.5), ("t", 2, 1, "assistant", "reply", 0.5),
             ("t", 2, 1, "assistant", "later reply", 0.5), ("t", 3, 2, "user", "leaf", None), ("t", 3, 2, "user", "leaf", 0.1),
             ("t", None, 3, "user", "nowhere", 9.0)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, role string, text string, score double")
    got = chat.format_trees(df, branches=3).select("score", chat.read_turns(F.col("formatted")).alias("turns")).collect()
    assert [[t["text"] for t in r["turns"]] for r in got] == [["root", "later reply", "leaf"]]
    assert got[0]["score"] == 0.5


def test_chat_long_chain(spark):
    n = 37
    rows = [("t", i, i - 1 if i else None, "user", str(i), 0.0) for i in range(n)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    [r] = chat.format_trees(df).select(chat.read_turns(F.col("formatted")).alias("turns")).collect()
    assert [t["text"] for t in r["turns"]] == [str(i) for i in range(n)]


def test_topk(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(400)]
    rows += [(1000, rows[3][1]), (1001, rows[3][1]), (1001, rows[3][1]), (1002, None), (1003, [float("nan")] * 6)]
    rows += [(1004, [None] + [0.1] * 5), (None, [0.5] * 6), (1005, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("shard", F.lit(0))
    got = topk.exact_topk(df, F.col("vec_id") % 50 == 0, shard_rows=64, block_rows=3).collect()
    good = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows if i is not None and i not in (1002, 1003, 1004)}
    want = []
    for q in good:
        if q % 50 == 0:
            found = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(found)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.exact_topk(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    huge = spark.createDataFrame([(0, [3e6, 1.0]), (1, [2e6, -1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = topk.exact_topk(huge, F.col("vec_id") == 0).collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 256 * 3000000 * 256 * 2000000 - 65536), (2, 256 * 3000000 * 256 + 65536)]


def test_topk_broadcasts_no_blocks(spark):
    df = spark.range(200).select(F.col("id").alias("vec_id"), F.array(*[F.rand(i).cast("float") for i in range(4)]).alias("embedding"))
    found = topk.exact_topk(df, F.col("vec_id") % 50 == 0, shard_rows=20, block_rows=1)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [dim#" in plan and "BroadcastHashJoin [dim#" not in plan


def test_topk_packs_numbers_of_any_size():
    for top in (1, 1 << 15, 1 << 31, 1 << 62):
        values = np.array([[top, -top], [0, 1]], "<i8")
        assert (topk.unpacked(topk.packed(values), 2, 2) == values).all()
    assert topk.unpacked(topk.packed(np.zeros(0, "<i8")), 0, 3).shape == (0, 3)


def test_topk_of_many_shards_at_once(spark, monkeypatch):
    """Shards that one task searches in turn: one tree each, thresholds handed on, values of any size."""
    import random

    rng = random.Random(4)
    rows = [(i, [rng.choice((1, -1)) * 10.0 ** rng.randint(-3, big) for _ in range(5)]) for big in (0, 9) for i in range(big * 1000, big * 1000 + 300)]
    rows.append((7000, [9e18, 9e18, 9e18, 9e18, 9e18]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    low, high = -(1 << 63), (1 << 63) - 1
    whole = {r["vec_id"]: list(r["v"]) for r in df.select("vec_id", topk.quantized(F.col("embedding")).alias("v")).collect()}
    want = []
    for q in (i for i in whole if i % 100 == 0):
        score = {i: min(max(sum(a * b for a, b in zip(whole[q], v, strict=True)), low), high) for i, v in whole.items() if i != q}
        want += [(q, k + 1, i, score[i]) for k, i in enumerate(sorted(score, key=lambda i: (-score[i], i))[:5])]
    got = topk.exact_topk(df, F.col("vec_id") % 100 == 0, shard_rows=50, block_rows=2).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_ngram_join(docs, none):
    got = {r["doc_id"]: r for r in bandjoin.similar_documents(docs).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7}
    assert all(got[i]["class_id"] == i and got[i]["n_links"] == 0 for i in got)
    assert bandjoin.similar_documents(none).count() == 0


def test_language_and_quality(spark, docs, none):
    train = [(i, f"der hund und die katze sind nicht hier {i}", "de") for i in range(40)]
    train += [(100 + i, f"the dog and the cat were not there {i}", "en") for i in range(40)] + [(300, None, "en"), (301, "x", None)]
    df = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = langid.fit(df)
    label = langid.identify(model, spark)
    mixed = spark.createDataFrame([(1, "the cat and the dog der hund und die katze"), (2, None), (3, "12 ² !"), (4, "HUND " * 30000)], "id int, text string")
    got = {r["id"]: r["f"] for r in mixed.select("id", label("text").alias("f")).collect()}
    assert [(x["lang"], x["words"]) for x in got[1]["runs"]] == [("en", 5), ("de", 5)]
    assert got[2]["lang_pred"] == got[3]["lang_pred"] == "und" and got[2]["score"] == 0
    assert got[4]["lang_pred"] == "de"
    empty = langid.identify(langid.fit(none), spark)
    assert {r["f"]["lang_pred"] for r in docs.select(empty("text").alias("f")).collect()} == {"und"}
    rated = spark.createDataFrame([(i, 2 if i < 100 else 0) for i, _, _ in train], "doc_id long, grade int")
    scored = {r["doc_id"]: r for r in quality.score(df, quality.fit(df, rated)).collect()}
    assert scored[3]["tail_prob"] > 0.5 > scored[120]["tail_prob"] and scored[300]["expected_grade"] == 0
    undecided = quality.fit(df, rated.where("false"))
    assert {round(r["tail_prob"], 3) for r in quality.score(df.where("doc_id < 9"), undecided).collect()} == {0.333}
    assert quality.score(none, undecided).count() == 0


def test_ordinal_slopes_are_those_of_the_loss():
    import numpy as np

    rng = np.random.default_rng(1)
    s, y, theta, weight = rng.normal(size=40) * 2, rng.integers(0, 3, 40), np.array([-0.7, 0.4]), rng.uniform(0.5, 2, 40)
    _, by_score, by_theta = quality.loss_and_slopes(s, y, theta, weight)

    def loss(s, theta):
        cuts = [-np.inf, theta[0], theta[0] + np.exp(theta[1]), np.inf]
        p = [1 / (1 + np.exp(a - cuts[g + 1])) - 1 / (1 + np.exp(a - cuts[g])) for a, g in zip(s, y, strict=True)]
        return -np.mean(weight * np.log(p))

    h = 1e-5
    assert np.allclose(by_score, [(loss(s + h * e, theta) - loss(s - h * e, theta)) / (2 * h) for e in np.eye(40)], atol=1e-7)
    assert np.allclose(by_theta, [(loss(s, theta + h * e) - loss(s, theta - h * e)) / (2 * h) for e in np.eye(2)], atol=1e-7)


def test_grades_of_held_out_documents(spark):
    """Toxic documents are found and good ones left alone, on rows that the fit never sees."""
    import os

    folder = "/root/testdata/sf0.1"
    if not os.path.exists(folder):
        pytest.skip("no test data")
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    ratings = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.expr(quality.GRADE_SQL).alias("rated"))
    ratings = ratings.where("rated IS NOT NULL")
    model = quality.fit(texts, ratings.withColumnRenamed("rated", "grade"))
    judged = texts.join(ratings.where(quality.held_out(F.col("doc_id"))), "doc_id")
    rows = quality.score(judged, model).join(ratings, "doc_id").groupBy("rated", "grade").count().collect()
    seen = {(r["rated"], r["grade"]): r["count"] for r in rows}
    share = {(a, b): seen.get((a, b), 0) / sum(seen.get((a, g), 0) for g in range(3)) for a in range(3) for b in range(3)}
    assert share[0, 0] >= 0.6 and share[2, 2] >= 0.95 and share[1, 1] >= 0.9, seen


def test_ratings_with_a_null_part_are_none(spark):
    rows = [(1, None), (None, 1), (0, None), (None, 0), (1, 1), (0, 0), (0, 1)]
    df = spark.createDataFrame(rows, "toxic int, quality int").select(F.expr(quality.GRADE_SQL).alias("g"))
    assert [r["g"] for r in df.collect()] == [None] * 4 + [0, 1, 2]


def test_forward_backward_is_exact():
    import numpy as np

    rng = np.random.default_rng(3)
    lengths = np.array([1, 5, 64, 65, 200, 129])
    scores, trans = rng.normal(size=(lengths.sum(), 3)), rng.normal(size=(3, 3))
    got = langid.posteriors(scores, trans, lengths)
    want, _, _ = langid._chains(scores, trans, lengths)
    assert np.allclose(got, want)


def test_html(spark, none):
    html = """<html><head><title>T</title><script>var a="</p>";</script></head><body class="ad-free"><header><h1>Site</h1></header>
    <nav><a href='x>y'>Home</a></nav><div class="cookie-notice">We use cookies.</div><article><h1>Head &amp; line</h1>
    <p>First   paragraph, with <b>bold<br>and a break.<p>Second &eacute;&am <a href=q>link</a> text in it, long enough.</p>
    <section class="comments"><p>Nice article, says a reader here.</p></section></article><form><p>Mail us</p></form><footer>&copy; x</footer>"""
    assert htmlcut.main_text(html, htmlcut.fit(spark.createDataFrame([(1, html)] * 3, "page_id long, html string"))) == (
        "Head & line\nFirst paragraph, with bold and a break.\nSecond é&am link text in it, long enough."
    )
    pages = spark.createDataFrame([(1, None, None), (1, None, None), (None, "u", ""), (2, "u", "<p>"), (3, "u", "<article>" + "<p>some words of text." * 3000)],
                                  "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = htmlcut.extract_text(pages, htmlcut.fit(pages)).collect()
    assert len(got) == 5 and sum(r["text"] == "" for r in got) == 4
    assert next(r["text"] for r in got if r["page_id"] == 3).count("\n") == 2999
    assert htmlcut.extract_text(pages.where("false"), htmlcut.fit(pages.where("false"))).count() == 0


def test_min_cut_against_all_labellings():
    import itertools
    import random

    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 7)
        gain = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(i, j, rng.randint(0, 6)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

        def cost(side, gain=gain, edges=edges):
            own = sum(max(g, 0) if not s else max(-g, 0) for g, s in zip(gain, side, strict=True))
            return own + sum(c for u, v, c in edges if side[u] != side[v])

        assert cost(htmlcut.source_side(gain, edges)) == min(map(cost, itertools.product((False, True), repeat=n)))


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame(
        [(1, "What colour is the old house by the river near the town? It is painted in a very dark shade of red."),
         (2, "One sentence only without any answer that follows it here"), (3, None), (4, ""), (None, "null item is it kept anyway by the index")],
        "item_id long, text string",
    )
    leak = LONG + " what colour is the old house by the river near the town it is painted in a very dark shade of red " + LONG
    half = "What colour is the old house by the river near the town? Nobody knows this at all."
    texts = docs.select("doc_id", "text", "key").unionByName(
        spark.createDataFrame([(50, leak, "k"), (51, half, "k"), (52, "so. ONE sentence, only without any answer that follows it here", None)], "doc_id long, text string, key string")
    )
    for block in (400_000, 10):
        got = decontaminate.contaminated(texts, items, block_postings=block).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(50, 1), (52, 2)]
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(docs, items.where("false")).count() == 0


def test_wand_against_every_score():
    import random

    rng = random.Random(2)
    for _ in range(60):
        n, t = rng.randint(1, 60), rng.randint(1, 12)
        rows = [(i, j, rng.random()) for i in range(n) for j in range(t) if rng.random() < 0.4] or [(0, 0, 0.5)]
        index = decontaminate.Index(rows, [(i, [], []) for i in range(n)])
        used = index.terms.tolist()
        terms = rng.sample(range(len(used)), rng.randint(1, len(used)))
        total = {}
        for i, j, s in rows:
            if j in {used[k] for k in terms}:
                total[i] = total.get(i, 0) + s
        least = rng.choice((0.2, 1.0, 2.0))
        got = sorted(i for i, _ in index.search(terms, least))
        assert got == sorted(i for i, s in total.items() if s >= least - 1e-9)


def best_split(word, table):
    cost = {p: (c, i) for p, i, c in table.costs}
    best, back = [0], [None]
    for end in range(1, len(word) + 1):
        found = None
        for n in range(1, min(table.longest, end) + 1):
            part = word[end - n:end]
            if part not in cost and n > 1:
                continue
            c, i = cost.get(part, (table.unknown_cost, table.size + ord(part[0])))
            if found is None or best[end - n] + c <= found[0]:
                found = (best[end - n] + c, n, i)
        best.append(found[0])
        back.append(found[1:])
    out, end = [], len(word)
    while end:
        out.append(back[end][1])
        end -= back[end][0]
    return out[::-1]


@pytest.fixture(scope="module")
def small_table():
    texts = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "ca", "aa", "aaaa"]
    scores = [-3.0, -2.5, -2.5, -2.75, -3.0, -4.0, -5.5, -3.5, -5.25, -5.0, -10.0]
    byte_ids = {b: 100 + b for b in range(256)}
    return pieces.PieceTable([(t, i, s) for i, (t, s) in enumerate(zip(texts, scores, strict=True))], byte_ids, 99, 400)


def test_viterbi_against_python(spark, small_table):
    import random

    rng = random.Random(4)
    words = {"a" * 700, "☃", "a☃b", "abc" * 100, "▁abca"} | {"".join(rng.choice("abc") for _ in range(rng.randint(1, 150))) for _ in range(30)}
    got = pieces.segmented(spark.createDataFrame([(w,) for w in words], "word string"), small_table).collect()
    assert {r["word"]: list(r["ids"]) for r in got} == {w: best_split(w, small_table) for w in words}


def test_pieces_round_trip(docs, none, small_table):
    for size in (1 << 24, 100):
        got = pieces.decode(pieces.encode(docs, small_table, chunk_chars=size), small_table).collect()
        want = sorted((i is None, i, t or "") for i, t in TEXTS)
        assert sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in got) == want
        assert all(list(r["ids"]) == [] for r in got if r["doc_id"] in (3, 4))
    assert pieces.encode(none, small_table).count() == 0
    assert hashlib.sha256(b"").hexdigest()


def test_pieces_of_equal_partitions(spark, small_table):
    """Chunks that are equal, or equal but for their words, all come back."""
    def sent(*parts):
        frames = [spark.createDataFrame(p, "doc_id long, text string").coalesce(1) for p in parts]
        df = frames[0]
        for f in frames[1:]:
            df = df.union(f)
        got = pieces.decode(pieces.encode(df, small_table, 1000), small_table).collect()
        want = [(i, t or "") for p in parts for i, t in p]
        assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(i), t) for i, t in want)

    sent([(1, None), (2, "")], [(1, None), (2, "")])
    sent([(1, "abc cab"), (2, "abc")], [(1, "abc cab"), (2, "abc")])
    sent([(None, " a")], [(None, " b")])
    sent([(1, "abc" * 400)] * 3)


def test_html_end_tags(spark):
    """An element without an end tag hides no later text."""
    def shown(html):
        return " ".join(b.text for b in htmlcut.blocks_of(html)).split()

    tail = "<article>kept</article>"
    for head in (
        "<datalist><option value=a>x<option value=b>y</datalist>", "<svg viewBox='0'/>", "<math/>", "<svg><path d=1></svg>",
        "<div><svg><title>x</svg></div>", "<svg><style/></svg>", "<select><option>x<option>y</select>", "<div><button>x</div>",
        "<button>x", "<select><option>x", "<option>x", "<template>x", "<noscript>x", "<svg><style>x",
        "<script>x</SCRIPT>", "İ<script>x</SCRIPT\n>", "İ<style>x</STYLE>", "<Title>x</tITLE>", "<title>x</titles></title>",
    ):
        for rest in ("", "<option>x</option>", "<div><button>x</button></div>", "<svg></svg>"):
            assert [w for w in shown(head + tail + rest) if w != "İ"] == ["kept"], (head, rest)
    for hidden in ("<button><div>x</div></button>", "<svg><foreignObject><p>x</p></foreignObject></svg>",
                   "<template><div>x</div></template>", "<noscript><p>x</p></noscript>", "<select><optgroup><option>x</optgroup></select>"):
        assert shown(f"<p>a{hidden}b</p>") in (["a", "b"], ["ab"])
    assert shown("<p>a</p><script>x" + tail) == shown("<p>a</p><style>x" + tail) == ["a"]


def test_html_formulas_and_deep_pages():
    """The text of formulas and embedded objects is text; a page nested very deep costs no more than its tags."""
    [a, b] = htmlcut.blocks_of("<article><p>Let <math><mi>x</mi>=2</math> hold.<p>a <object data=q>fall back</object> b</article>")
    assert (a.text, b.text) == ("Let x=2 hold.", "a fall back b")
    deep = htmlcut.blocks_of("<main>" + "<div>x" * 50_000 + "</p>" * 50_000 + "<p>y")
    assert len(deep) == 50_001 and all(x.content for x in deep)
    assert len(htmlcut.ties(deep)) >= 50_000
    at = {x.text: x.place for x in htmlcut.blocks_of("<div><p>a</p><ul><li>b<li>c</ul></div><p>d</p>")}
    pairs = {"ab": 3, "bc": 2, "ad": 3, "aa": 0}
    assert {k: htmlcut.tree_distance(at[k[0]], at[k[1]]) for k in pairs} == pairs
    assert htmlcut.tree_distance(None, at["a"]) == 2


def test_long_words(spark, small_table):
    """Words of many blocks, cut over tasks: the edges hold no word, and the path is the exact one."""
    import random

    rng = random.Random(9)
    n = pieces.LONG
    words = ["a" * 30_000, "".join(rng.choice("abc") for _ in range(20_000)), "☃" * (n + 1), "abc" * n, "b" * n, "c" * (n + 1)]
    words += ["".join(rng.choice("abc☃𝒳") for _ in range(n + k)) for k in (1, 63, 64, 65)]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r["word"]: list(r["ids"]) for r in pieces.segmented(frame, small_table).collect()}
    assert got == {w: best_split(w, small_table) for w in words}
    sizes = pieces.long_edges(frame.where(f"char_length(word) > {n}"), small_table).selectExpr("max(size(edges)) AS m").first()
    assert sizes["m"] <= pieces.BLOCK * small_table.longest


def test_fits_hold_their_bound_for_repeated_ids(spark, monkeypatch):
    """One id repeated many times is one training document, as each fit's bound says."""
    many = spark.range(2000).select(
        F.lit(2).cast("long").alias("doc_id"), F.concat(F.lit("some words of a text "), F.col("id")).alias("text"), F.lit("en").alias("lang")
    )
    few = spark.createDataFrame([(i, f"other text number {i}", "de") for i in range(30)], "doc_id long, text string, lang string")
    both = many.unionByName(few)
    assert langid._sample(both, 10).groupBy("lang").count().where("count > 10").count() == 0
    seen = []
    rows_of = quality._sparse_rows
    monkeypatch.setattr(quality, "_sparse_rows", lambda df: seen.append(df.count()) or rows_of(df))
    quality.fit(both, both.select("doc_id", F.lit(1).alias("grade")), fit_rows=5, rounds=2)
    assert seen == [5]
    pages = many.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("html"))
    assert htmlcut.fit(pages, rounds=1).shape == htmlcut.fit(pages.limit(1), rounds=1).shape


def test_words_of_chunks_travel_packed(spark, small_table):
    """A row for each bucket of a chunk's words, not for each word; every number comes back from its bytes."""
    words = [f"{a}{b}{c}{d}" for a in "abc☃" for b in "abxy" for c in "abcd" for d in "a\0\x01é"]
    docs = spark.createDataFrame([(i, " ".join(words)) for i in range(4)], "doc_id long, text string").coalesce(1)
    rows = pieces.pack(docs, small_table, 1, buckets=3).groupBy("chunk").count().collect()
    assert len(rows) == 4 and all(r["count"] <= 4 for r in rows)
    assert {r["text"] for r in pieces.decode(pieces.encode(docs, small_table, 1), small_table).collect()} == {" ".join(words)}
    numbers = [0, 1, 255, 256, 70_000, 2**31 - 1]
    assert list(pieces._unboxed(pieces._boxed([], numbers, text=b"x"), 2)[1]) == numbers
