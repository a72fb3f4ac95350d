"""Families against all-pairs comparison; body normalisation on hand-written bodies."""

import random
import re

import pytest

from touchgrid.operators import similarity as sim
from touchgrid.plans import reuse


def texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    out = [""]
    for _ in range(6):
        base = [rng.choice(words) for _ in range(40)]
        for _ in range(9):
            t = list(base)
            for _ in range(rng.choice([0, 1, 3, 6])):
                t[rng.randrange(40)] = rng.choice(words)
            out.append(" ".join(t))
    return sorted(set(out + ["two words", "just three words"]))


def brute(ts, threshold, k=4):
    def sh(t):
        w = t.split()
        return {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({t} if t else set())

    sets, root = [sh(t) for t in ts], list(range(len(ts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ts)):
        for j in range(i):
            u = sets[i] | sets[j]
            if u and len(sets[i] & sets[j]) / len(u) >= threshold:
                root[find(i)] = find(j)
    return {frozenset(t for x, t in enumerate(ts) if find(x) == r) for r in {find(x) for x in range(len(ts))}}


@pytest.mark.parametrize("threshold", [0.45, 0.7])
def test_exact_families(spark, threshold):
    ts = texts()
    unique = sim.unique_texts(spark.createDataFrame([(t,) for t in ts], "core_norm string"))
    got = {}
    for r in sim.text_families(unique, threshold=threshold, exact=True).join(unique, "text_key").collect():
        got.setdefault(r.family, set()).add(r.text)
    assert {frozenset(g) for g in got.values()} == brute(ts, threshold)


def test_normalisation(spark):
    body = (
        "<div>Hi Jane,</div><div>Loved your work at Acme on vision models &amp; more.</div><div>See https://a.b/c now !</div>"
        "<div>Best,</div><div>Will Sample</div><div>Commercial Associate</div>"
        "<blockquote>On July 1, 2026 at 9AM, Will Sample &lt;will@corp.example.com&gt; wrote: earlier</blockquote>"
    )
    df = spark.createDataFrame(
        [("1", body, "Jane", "Doe", "Acme", "VP Eng", "Will Sample"), ("2", None, None, None, None, None, None)],
        "activity_id string, body_html string, contact_firstname string, contact_lastname string, account_name string, "
        "contact_jobtitle string, ca_name string",
    )
    got = {r.activity_id: r for r in reuse.normalize_bodies(df, "corp.example.com", "corp").collect()}
    assert got["1"].core_norm == "loved your work at <acct> on vision models & more. see <url> now!"
    assert got["1"].has_quote and got["1"].is_selfbump and not got["1"].is_reply and got["1"].sig_removed
    assert got["2"].core_norm == "" and not got["2"].has_quote


def test_pairs_on_the_threshold_are_kept(spark):
    from touchgrid.operators import similarity as sim

    rows = []
    for p in range(6):
        words = [f"p{p}w{i}" for i in range(103)]
        rows += [(" ".join(words),), (" ".join(words[:58]),)]
    df = spark.createDataFrame(rows, "core_norm string")
    fams = sim.text_families(sim.unique_texts(df), threshold=0.55, exact=True)
    assert fams.select("family").distinct().count() == 6


def test_missed_blasts_count_by_the_labels_family(spark):
    labelled = spark.createDataFrame([("1", "Personalized", 1), ("2", "Personalized", 2)], "activity_id string, pred string, fam_size int")
    truth = spark.createDataFrame([("1", "Templated", 12), ("2", "Templated", 9)], "activity_id string, label string, fam_sim int")
    assert reuse.evaluate(labelled, truth).first().hard_blast == 1


def test_sweep_covers_the_grid(spark):
    """Every word-window length by every threshold; cells together are as when run alone."""
    from touchgrid.catalog.texts import SWEEP

    k_t = [(k, t) for k in (1, 3, 4, 5) for t in (0.3, 0.4, 0.45, 0.5, 0.55, 0.6, 0.7)]
    assert SWEEP == k_t
    rng = random.Random(3)
    base = [[rng.choice("abcdefghijklmnopqrst") * 2 for _ in range(20)] for _ in range(4)]
    texts = [" ".join(w if rng.random() > 0.08 else "zz" for w in b) for b in base for _ in range(6)]
    rows = [(str(i), x, i % 2 == 0, "a@example.org") for i, x in enumerate(texts)]
    corpus = spark.createDataFrame(rows, "activity_id string, core_norm string, is_reply boolean, contact_email string")
    truth = spark.createDataFrame([("1", "Templated", 12), ("2", "Personalized", 1)], "activity_id string, label string, fam_sim int")
    grid = [(1, 0.3), (1, 0.7)]
    together = {(r.k, r.threshold): r for r in reuse.sweep(corpus, truth, grid, [3], exact=True).collect()}
    for cell in grid:
        fam = sim.text_families(sim.unique_texts(corpus), *cell, exact=True)
        assert together[cell].templated == reuse.label_corpus(corpus, families=fam).where("fam_size >= 3").count()


def test_nearest_other_with_a_shingle_on_every_text(spark):
    """A shingle that all share: the same answers as all pairs, and no row for each pair."""
    rng = random.Random(5)
    ends = ["", " common tail of all four words", " second tail of words here"]
    left = [(f"t{i}", f"f{i % 9}", " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(4, 12))) + rng.choice(ends)) for i in range(150)]
    reps = [(f"f{i}", " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(4, 12))) + ends[i % 3]) for i in range(60)]

    def sets(text):
        w = text.split()
        return {" ".join(w[i:i + 4]) for i in range(len(w) - 3)}

    want = {}
    for key, family, text in left:
        a = sets(text)
        scored = [(-(len(a & b) / len(a | b)), f) for f, b in ((f, sets(t)) for f, t in reps) if f != family and a & b]
        want[key] = min(scored) if scored else (0.0, None)
    x = spark.createDataFrame(left, "text_key string, family string, text string")
    y = spark.createDataFrame(reps, "family string, text string")
    for postings in (0, 8, 1000):
        got = {r.text_key: (-r.nearest_j, r.nearest_family) for r in sim.nearest_other(x, y, postings=postings).collect()}
        assert {k: (round(d, 9), f) for k, (d, f) in got.items()} == {k: (round(d, 9), f) for k, (d, f) in want.items()}


def test_minhash_equals_its_definition_and_close_keys_lose_no_family(spark):
    """Signatures against plain arithmetic; the exact families against all pairs."""
    import hashlib

    from pyspark.sql import functions as F

    from touchgrid import vocab
    from touchgrid.operators import similarity as sim
    from touchgrid.session import stored

    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base[:n] + [f"x{j}"] * (j % 3)) for j, n in enumerate((40, 39, 30, 21, 12, 5, 4, 3, 1))] + ["", "one two"]
    df = spark.createDataFrame([(t,) for t in texts], "core_norm string")
    unique = sim.unique_texts(df)

    def windows(t):
        w = t.split()
        return set() if not w else {" ".join(w[i:i + 4]) for i in range(max(len(w) - 3, 1))}

    sets = {hashlib.md5(t.encode()).hexdigest(): windows(t) for t in texts}
    p = vocab.MINHASH_PRIME
    for r in stored(sim.text_sets(unique, 4)).select("text_key", sim.minhash(F.col("block")).alias("sig")).collect():
        own = [int(hashlib.md5(w.encode()).hexdigest()[:15], 16) % p for w in sets[r.text_key]]
        assert list(r.sig) == [min(((x * a + c) % p for x in own), default=0) for a, c in sim.minhash_coefficients()]
    near = lambda a, b: not (a | b) or len(a & b) / len(a | b) >= 0.45
    want = {k: k for k in sets}
    for _ in sets:
        want = {k: min(want[o] for o in sets if near(sets[k], sets[o])) for k in sets}
    assert {r.text_key: r.family for r in sim.text_families(unique, exact=True).collect()} == want


def test_shared_sets_hold_what_other_texts_have_too(spark):
    """Windows of odd texts against plain sets: rarest first, unique ones only counted, in any number of buckets."""
    from collections import Counter

    rng = random.Random(7)
    ts = [" ".join(rng.choice("aé\U0001f600") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 30))) for _ in range(60)]
    ts = sorted({*ts, "", " ", "a", "a a", "a　b\x1cc\xa0d e", "a b c d e", "x" * 3000 + " b c d"})

    def windows(t, k):
        w = t.split()
        return {" ".join(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()

    unique = sim.unique_texts(spark.createDataFrame([(t,) for t in ts], "core_norm string"))
    key = {r.text: r.text_key for r in unique.collect()}
    for k in (1, 4):
        for size in (1 << 20, 50):
            sim.BUCKET_SHINGLES, before = size, sim.BUCKET_SHINGLES
            try:
                got = {r.text_key: r for r in sim.shared_sets(unique, k).collect()}
            finally:
                sim.BUCKET_SHINGLES = before
            df = Counter(w for t in ts for w in windows(t, k))
            held = Counter(x for r in got.values() for x in r.score)
            assert len(got) == len(ts)
            for t in ts:
                r, own = got[key[t]], windows(t, k)
                assert (r.n, r.n_words) == (len(own), len(t.split()))
                assert [held[x] for x in r.score] == sorted(df[w] for w in own if df[w] > 1)
            a, b = rng.sample(ts, 2)
            assert len({*got[key[a]].score} & {*got[key[b]].score}) == len(windows(a, k) & windows(b, k))


def test_labels_carry_no_texts_but_where_asked(spark):
    """The labels that most queries read are small; representatives are the same without the texts."""
    from types import SimpleNamespace

    from touchgrid.catalog import texts as cat

    rows = [(str(i), x, i % 2 == 0) for i, x in enumerate(["a b c d e", "a b c d e", "a b c d e f", "z", ""])]
    corpus = spark.createDataFrame(rows, "activity_id string, core_norm string, is_reply boolean")
    t = SimpleNamespace(memo={})
    before, cat.corpus = cat.corpus, lambda _: corpus
    try:
        slim, full = cat.labelled(t), cat.worded(t)
    finally:
        cat.corpus = before
    assert "core_norm" not in slim.columns and "core_norm" in full.columns
    want = {(r.family, r.rep_key) for r in reuse.representatives(full).collect()}
    assert {tuple(r) for r in reuse.representative_keys(slim).collect()} == want and len(want) == 3


def test_only_references_go_through_python(spark):
    """Odd references as html.unescape reads them; the plan hands Python the references, not the texts."""
    import html

    from pyspark.sql import functions as F

    from touchgrid.functions.html import unescape

    odd = ["", "&", "&&amp;&", "&amp;lt;", "a &notit; b &not", "&#0;&#x80;&#xD800;&#x110000;&#1;", "&#12345678901;", "&nosuchentity;x", "é&eacute&Eacute;",
           "\U0001f600&#x1F600;\U0001f600" + "é" * 40, "&" + "a" * 40 + ";", "&lt;b&gt;&nbsp;\n&\n&#x;&#;", "$1 \\ &quot;$0\\&quot;", "&#" + "٣;", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i int, t string").withColumn("u", unescape("t"))
    assert [r.u for r in df.orderBy("i").collect()] == [t if t is None else html.unescape(t) for t in odd]
    calls = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "ArrowEvalPython" in x]
    assert len(calls) == 1 and "_characters(" in calls[0]


def test_squeezed_white_space_by_one_class(spark):
    from pyspark.sql import functions as F

    from touchgrid.catalog.texts import core
    from touchgrid.functions import text as tx

    every = "".join(f"a{c}b{c}{c} c" for c in tx.SPACE_CHARS)
    near = "x​yᙿzᚁ 、 ‌ \x1b\x7f\x84\x86"
    rows = [(t,) for t in (every, near, every + near, " a , b ;\n: c . ,", tx.SPACE_CHARS, "", "a b", None)]
    for r in spark.createDataFrame(rows, "t string").select("t", tx.squeeze("t").alias("s"), core(F.col("t")).alias("c")).collect():
        if r.t is None:
            assert r.s is None and r.c is None
            continue
        parts = re.split(f"[{tx.SPACE_CHARS}]+", r.t)
        assert r.s == " ".join(parts)
        assert r.c == re.sub(r" ([,.!?;:])", r"\1", r.s.lower().strip(" "))
    assert "|" not in tx.BLANKS and r"\s" not in tx.BLANKS


def test_variation_from_marks_and_shared_sets(spark):
    ts = texts()
    rows = [(str(i), t, i % 2 == 0) for i, t in enumerate(ts + ts[:12] + [f"new {i}. " + ts[20] for i in range(3)])]
    corpus = spark.createDataFrame(rows, "activity_id string, core_norm string, is_reply boolean")
    labelled = reuse.label_corpus(corpus, exact=True).selectExpr("*", "length(core_norm) AS core_len").cache()
    marked = reuse.mark_texts(labelled).drop("core_norm")
    drift = reuse.family_drift(marked, sim.shared_sets(sim.unique_texts(corpus), 4))
    cols = ["activity_id", "vtype", "fam_exact", "fam_nofirst", "has_merge_tok", "drift_vs_rep"]
    whole, bare = (x.select(*cols).toPandas().sort_values("activity_id").to_csv(index=False) for x in (
        reuse.variation(labelled), reuse.variation(marked, drift=drift)))
    assert whole == bare and whole.count("\n") == len(rows) + 1
    counted = reuse.variation_prevalence(reuse.variation_types(marked))
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan and "core_norm" not in [c for c in marked.columns]
    assert sum(r.n for r in counted.collect()) == len(rows)


def test_band_families_of_all_cells_at_once(spark, monkeypatch):
    """Families of the texts that share a band, for buckets of any size, against all pairs; no job per cell."""
    from pyspark.sql import functions as F

    from touchgrid.session import stored

    ts = texts()
    unique = stored(sim.unique_texts(spark.createDataFrame([(t,) for t in ts], "core_norm string")))
    key = {r.text: r.text_key for r in unique.collect()}
    bands = {}
    for r in sim.band_keys(stored(sim.text_sets(unique, 4))).collect():
        bands.setdefault(r.text_key, set()).add(r.key)
    mine = {}
    for r in sim.band_members(unique).collect():
        mine.setdefault(r.text_key, set()).add(r.key)
    assert all(bool(bands[a] & bands[b]) == bool(mine[a] & mine[b]) for a in mine for b in mine)

    def windows(t, k):
        w = t.split()
        return {" ".join(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()

    grid = [(k, t) for k in (1, 4, 5) for t in (0.3, 0.45, 0.7)]
    want = set()
    for i, (k, limit) in enumerate(grid):
        sets = {key[t]: windows(t, k) for t in ts}
        near = {a: [b for b in sets if bands[a] & bands[b] and len(sets[a] & sets[b]) >= limit * len(sets[a] | sets[b])] for a in sets}
        least = {a: a for a in sets}
        for _ in sets:
            least = {a: min(least[b] for b in near[a]) for a in sets}
        want |= {(i, a, f) for a, f in least.items() if len(near[a]) > 1}
    assert len({i for i, _, _ in want}) == len(grid)
    for size in (64, 2, 1):
        monkeypatch.setattr(sim, "BUCKET_TEXTS", size)
        assert {tuple(r) for r in sim.band_families(unique, grid).collect()} == want
    jobs = []
    monkeypatch.setattr(sim, "BUCKET_TEXTS", 64)
    for cells in (grid[:1], grid * 3):
        spark.sparkContext.setJobGroup(f"cells {len(cells)}", "")
        sim.band_families(unique, cells).agg(F.count("*")).collect()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"cells {len(cells)}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] < 2 * jobs[0]


def test_sweep_of_banded_families_counts_rows(spark):
    """Counts from one row per text against the labels of all rows; no job per cell."""
    rng = random.Random(4)
    ts = texts()
    rows = [(str(i), rng.choice(ts), rng.choice([True, False, None])) for i in range(200)] + [("none", None, True)]
    corpus = spark.createDataFrame(rows, "activity_id string, core_norm string, is_reply boolean")
    told = [(str(i), rng.choice(["Templated", "Personalized", None]), rng.choice([1, 12, None])) for i in range(0, 260, 2)]
    truth = spark.createDataFrame(told, "activity_id string, label string, fam_sim int")
    grid, sizes = [(1, 0.3), (4, 0.45), (4, 0.7)], [2, 5]
    got = {(r.k, r.threshold, r.least_size): r for r in reuse.sweep(corpus, truth, grid, sizes).collect()}
    assert len(got) == len(grid) * len(sizes)
    label = {i: (x, f) for i, x, f in told}
    for k, t in grid:
        fam = sim.text_families(sim.unique_texts(corpus), k, t)
        sized = [(r.fam_size, r.is_reply, *label.get(r.activity_id, (None, None))) for r in reuse.label_corpus(corpus, families=fam).collect()]
        for least in sizes:
            r, big = got[k, t, least], [x for x in sized if x[0] >= least]
            small = [x for x in sized if x[0] < least]
            has = lambda xs, what: sum(x[2] == what for x in xs)
            want = (len(sized), len(big), sum(x[1] is False for x in big), has(big, "Templated"), has(small, "Personalized"),
                    has(big, "Personalized"), has(small, "Templated"), sum(x[2] == "Templated" and (x[3] or 0) >= 10 for x in small))
            assert (r.n, r.templated, r.fresh_templated, r.tp, r.tn, r.fp, r.fn, r.hard_blast) == want


def test_banded_families_write_no_sets(spark, monkeypatch):
    """Sets of windows are larger than the texts; only pairs that share a band are compared, from their texts."""
    monkeypatch.setattr(sim, "text_sets", None)
    ts = [" ".join(f"w{j}" for j in range(i, i + 30)) for i in (0, 1, 100)]
    unique = sim.unique_texts(spark.createDataFrame([(t,) for t in ts], "core_norm string"))
    got = {r.text: r.family for r in sim.text_families(unique).join(unique, "text_key").collect()}
    assert got[ts[0]] == got[ts[1]] != got[ts[2]]


def test_nearest_representative_reads_no_texts(spark):
    """From shared sets and labels without texts: as from the texts of all representatives."""
    from pyspark.sql import functions as F

    rng = random.Random(6)
    ts = texts()
    mixed = [" ".join(rng.choice(ts[2:]).split()[:20] + rng.choice(ts[2:]).split()[5:rng.randrange(6, 30)]) for _ in range(30)]
    rows = [(str(i), t, i % 2 == 0) for i, t in enumerate(ts + mixed + ts[:9])]
    corpus = spark.createDataFrame(rows, "activity_id string, core_norm string, is_reply boolean")
    full = reuse.label_corpus(corpus, exact=True).selectExpr("*", "length(core_norm) AS core_len").cache()
    left = full.groupBy("text_key", "family").agg(F.any_value("core_norm").alias("text"))
    want = {r.text_key: (r.nearest_family, round(r.nearest_j, 3)) for r in sim.nearest_other(left, reuse.representatives(full, 3)).collect()}
    slim, sets = full.drop("core_norm"), sim.shared_sets(sim.unique_texts(corpus), 4)
    got = {r.text_key: (r.nearest_family, r.nearest_j) for r in reuse.nearest_representative(slim, sets).collect()}
    assert got == want and len({f for f, _ in got.values()}) > 2
    near = {(r.activity_id, r.nearest_family, r.nearest_j) for r in reuse.near_misses(slim, sets, low=0.02).collect()}
    assert near == {(r.activity_id, *want[r.text_key]) for r in full.where("fam_size < 3").collect() if 0.02 <= want[r.text_key][1] < 0.5}
    assert near


def test_ablation_runs_all_choices_at_once(spark, monkeypatch):
    """The corpora of all choices in one run: as each by itself, with empty texts and texts that several choices share."""
    steps = ("strip_greeting", "neutralize_merge")
    bodies = [f"<div>Hi {n},</div><div>see our new plan for {a} and tell me what you think of {p} today</div>"
              for n in ("Ann", "Bob") for a in ("Acme Works", "Blue Ltd", "Acme Works") for p in ("it", "them all")]
    bodies += ["", "<div>Hi Ann,</div>", "<div>quite another text of some words</div>", "<blockquote>old</blockquote>"]
    bodies += [f"<div>Hi {n},</div><div>our first offer is ready</div>" for n in ("Cid", "Dan", "Eve")]
    rows = [(str(i), b, "Ann", "Doe", "Acme Works" if i % 3 else "Blue Ltd", "Engineer", "Will") for i, b in enumerate(bodies)]
    messages = spark.createDataFrame(rows, "activity_id string, body_html string, contact_firstname string, contact_lastname string, "
                                     "account_name string, contact_jobtitle string, ca_name string")
    truth = spark.createDataFrame([(str(i), "Templated" if i % 2 else "Personalized", i) for i in range(len(rows))], "activity_id string, label string, fam_sim int")
    monkeypatch.setattr(reuse, "STEPS", steps)
    runs, shared = [], reuse.shared_sets
    monkeypatch.setattr(reuse, "shared_sets", lambda *x: runs.append(1) or shared(*x))
    got = {r.switched_off: r[1:] for r in reuse.normalization_ablation(messages, truth, "corp.example.com", "corp", exact=True).collect()}
    assert len(runs) == 1
    for off in (None, *steps):
        corpus = reuse.normalize_bodies(messages, "corp.example.com", "corp", [s for s in steps if s != off])
        fam = sim.text_families(sim.unique_texts(corpus), exact=True)
        sized = [(r.activity_id, r.fam_size) for r in reuse.label_corpus(corpus, families=fam).collect()]
        small = [int(i) for i, n in sized if n < 3]
        want = (4, 0.45, 3, len(rows), len(rows) - len(small))
        assert got[off or "none"][:5] == want
        odd, even = len(rows) // 2, len(rows) - len(rows) // 2
        left = sum(i % 2 == 0 for i in small)
        assert got[off or "none"][6:9] == (odd - len(small) + left, left, even - left)
    assert len({tuple(x) for x in got.values()}) > 1
