"""Message reuse: body normalisation, template families, labels, stability, evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchgrid import vocab
from touchgrid.functions.html import html_to_text
from touchgrid.functions.text import rate, squeeze, strip, word_count, words
from touchgrid.operators.components import connected_components
from touchgrid.operators.keyed import rank_in_key
from touchgrid.operators.similarity import (
    band_families, close_keys, family_links, hashed_shingles, jaccard, nearest_by_sets, shared_sets, star_pairs, text_families,
    unique_texts, verify,
)
from touchgrid.session import stored

STEPS = ("strip_quote", "strip_greeting", "strip_sig", "strip_disclaimer", "neutralize_merge")
UNICODE = "(?U)"   # \\w, \\b and \\s follow Unicode
LINES = "(?d)"     # only \\n ends a line


# --------------------------------------------------------------- normalisation
def quote_flags(html: Column, text: Column, own_domain: str) -> tuple[Column, Column]:
    """(has_quote, quoted sender is internal; NULL when no sender is found)."""
    has = (
        html.rlike(r"(?i)<blockquote") | html.rlike(r"(?i)gmail_quote")
        | text.rlike(LINES + vocab.QUOTE_HEADER_PATTERN)
    )
    sender = F.lower(F.nullif(F.regexp_extract(text, vocab.QUOTE_SENDER_PATTERN, 1), F.lit("")))
    return has, sender.endswith("@" + own_domain)


def cut_quote(text: Column) -> Column:
    """Everything before the first quoted message."""
    for marker in (vocab.QUOTE_HEADER_PATTERN, vocab.ORIGINAL_MESSAGE_PATTERN, vocab.UNDERSCORE_RULE_PATTERN):
        text = F.split(text, LINES + marker, 2)[0]
    return text


def _word(value: Column, least: int, flags: str) -> Column:
    """Pattern for one merge value as a whole word; NULL when it is too short to trust."""
    v = strip(F.coalesce(value, F.lit("")))
    quoted = F.concat(F.lit("\\Q"), F.replace(v, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    return F.when(F.length(v) >= least, F.concat(F.lit(f"(?{flags}U)\\b"), quoted, F.lit("\\b")))


def neutralize(core: Column, account: Column, title: Column, first: Column, last: Column) -> Column:
    """Addresses and the row's own merge values become tokens."""
    core = F.regexp_replace(core, vocab.URL_PATTERN, " <URL> ")
    core = F.regexp_replace(core, UNICODE + vocab.EMAIL_PATTERN, " <EMAIL> ")
    for value, least, flags, token in (
        (account, 4, "i", " <ACCT> "), (title, 5, "i", " <TITLE> "), (first, 2, "", " <FN> "), (last, 2, "", " <LN> ")
    ):
        pattern = _word(value, least, flags)
        core = F.when(pattern.isNotNull(), F.regexp_replace(core, pattern, F.lit(token))).otherwise(core)
    return core


def open_bodies(messages: DataFrame, own_domain: str, html: str = "body_html") -> DataFrame:
    """Adds what every choice of steps reads of a message body: _full, _head (without quotes) and the quote flags."""
    h = F.coalesce(F.col(html), F.lit(""))
    rows = messages.withColumn("_full", html_to_text(h))
    has_quote, internal = quote_flags(h, F.col("_full"), own_domain)
    head = F.split(F.split(h, r"(?i)<blockquote", 2)[0], r"(?i)<div[^>]*gmail_quote", 2)[0]
    return rows.withColumns({"has_quote": has_quote, "quote_internal": internal, "_head": cut_quote(html_to_text(head))})


def normalize_bodies(
    messages: DataFrame, own_domain: str, own_brand: str, steps: Sequence[str] = STEPS, html: str = "body_html"
) -> DataFrame:
    """Adds core, core_norm and the flags of a message body.

    Reads contact_firstname, contact_lastname, account_name, contact_jobtitle and
    ca_name. Every step can be left out; quote detection always runs. messages: as they are, or
    with open_bodies.
    """
    rows = messages if "_full" in messages.columns else open_bodies(messages, own_domain, html)
    body = F.col("_head" if "strip_quote" in steps else "_full")
    rows = rows.withColumn("_text", body)
    rows = rows.withColumn(
        "_lines", F.filter(F.transform(F.split("_text", "\n"), strip), lambda x: x != "")
    ).withColumns({"sig_removed": F.lit(False), "disc_removed": F.lit(False)})

    if "strip_greeting" in steps:
        opening = F.try_element_at("_lines", F.lit(1))
        rest = strip(F.regexp_replace(opening, UNICODE + vocab.GREETING_PATTERN, ""))
        tail = F.slice("_lines", F.lit(2), F.greatest(F.size("_lines") - 1, F.lit(0)))
        rows = rows.withColumn(
            "_lines",
            F.when(
                F.coalesce(opening.rlike(UNICODE + vocab.GREETING_PATTERN), F.lit(False)),
                F.when(rest != "", F.concat(F.array(rest), tail)).otherwise(tail),
            ).otherwise(F.col("_lines")),
        )
    if "strip_sig" in steps:
        signed = F.array_position(F.transform("_lines", lambda x: x.rlike(vocab.SIGNOFF_PATTERN)), True)
        rows = rows.withColumn("_cut", signed)
        kept = F.when(F.col("_cut") > 0, F.slice("_lines", F.lit(1), (F.col("_cut") - 1).cast("int"))).otherwise(
            F.col("_lines")
        )
        rows = rows.withColumn("_lines", kept)
        domain, brand = own_domain.replace(".", r"\."), own_brand
        contact = vocab.CONTACT_LINE_PATTERN.format(domain=domain, brand=brand)
        name = F.coalesce(F.col("ca_name"), F.lit(""))
        first_name = F.split(name, r"\s+")[0]

        def residue(x: Column) -> Column:
            own = (name != "") & ((x == name) | (x == first_name)) & (F.length(x) < 40)
            return x.rlike(contact) | x.rlike(vocab.TITLE_LINE_PATTERN) | own

        rows = rows.withColumn("_kept", F.filter("_lines", lambda x: ~residue(x)))
        rows = rows.withColumn("sig_removed", (F.col("_cut") > 0) | (F.size("_kept") < F.size("_lines")))
        rows = rows.withColumn("_lines", F.col("_kept")).drop("_kept", "_cut")
    if "strip_disclaimer" in steps:
        rows = rows.withColumn("_kept", F.filter("_lines", lambda x: ~x.rlike(vocab.DISCLAIMER_PATTERN)))
        rows = rows.withColumn("disc_removed", F.size("_kept") < F.size("_lines"))
        rows = rows.withColumn("_lines", F.col("_kept")).drop("_kept")
    core = strip(F.array_join("_lines", "\n"))
    if "neutralize_merge" in steps:
        core = neutralize(
            core, F.col("account_name"), F.col("contact_jobtitle"), F.col("contact_firstname"), F.col("contact_lastname")
        )
    rows = rows.withColumn("core", core)
    norm = F.regexp_replace(strip(squeeze(F.lower("core"))), vocab.SPACE_BEFORE_MARK_PATTERN, "$1")
    return rows.withColumns(
        {
            "core_norm": norm,
            "is_reply": F.col("has_quote") & F.coalesce(~F.col("quote_internal"), F.lit(False)),
            "is_selfbump": F.col("has_quote") & F.coalesce(F.col("quote_internal"), F.lit(False)),
        }
    ).drop("_full", "_head", "_text", "_lines")


def with_counts(corpus: DataFrame) -> DataFrame:
    return corpus.withColumns({"core_len": F.length("core_norm"), "core_words": word_count("core_norm")})


def corpus_extract(activity_flat: DataFrame) -> DataFrame:
    """Counted outbound messages with the columns the analysis reads."""
    return activity_flat.where(F.col("counts") & F.col("channel").isin(*vocab.EMAIL_CHANNELS)).select(
        "activity_id", "ca_name", "channel", "subject_norm", "contact_firstname", "contact_lastname",
        "account_name", "contact_jobtitle", "contact_email", "occurred_at", "body_html",
    )


# -------------------------------------------------------------------- families
def label_corpus(
    corpus: DataFrame, k: int = vocab.DEFAULT_SHINGLE_WORDS, threshold: float = vocab.DEFAULT_FAMILY_THRESHOLD,
    least_size: int = vocab.DEFAULT_FAMILY_SIZE, exact: bool = False, length_aware: bool = False,
    count_recipients: bool = False, families: DataFrame | None = None,
) -> DataFrame:
    """Rows with text_key, family, fam_size and pred.

    A family is sized by its rows; `count_recipients` sizes it by distinct addresses.
    """
    rows = corpus if "text_key" in corpus.columns else corpus.withColumn("text_key", F.md5("core_norm"))
    if families is None:
        families = text_families(unique_texts(corpus), k, threshold, exact, length_aware)
    # Families are sized by keys alone, so that the rows and their texts are dealt out once.
    size = F.count_distinct("contact_email") if count_recipients else F.count(F.lit(1))
    keys = rows.select("text_key", "contact_email") if count_recipients else rows.select("text_key")
    sizes = keys.join(families, "text_key").groupBy("family").agg(size.alias("fam_size"))
    return rows.join(families.join(sizes, "family"), "text_key").withColumn(
        "pred", F.when(F.col("fam_size") >= least_size, "Templated").otherwise("Personalized")
    )


def representative_keys(labelled: DataFrame) -> DataFrame:
    """(family, rep_key): as representatives, by the lengths of texts (core_len) and without them."""
    longest = F.min_by("text_key", F.struct(-F.col("core_len"), F.col("text_key")))
    return labelled.groupBy("family").agg(longest.alias("rep_key"))


def representatives(labelled: DataFrame, least_size: int = 1) -> DataFrame:
    """Per family its longest text (smallest key on ties)."""
    return (
        labelled.where(F.col("fam_size") >= least_size)
        .groupBy("family")
        .agg(F.min_by(F.struct("core_norm", "text_key"), F.struct(-F.length("core_norm"), "text_key")).alias("r"))
        .select("family", F.col("r.core_norm").alias("text"), F.col("r.text_key").alias("rep_key"))
    )


def without_first_sentence(c: Column) -> Column:
    """Text after its first sentence, when enough of it is left."""
    rest = F.regexp_extract(c, r"(?s)^.*?[.!?]\s+(.*)$", 1)
    return F.when(F.length(rest) > 20, rest).otherwise(c)


def mark_texts(rows: DataFrame) -> DataFrame:
    """What the types of variation read of a row's text, and its number of words."""
    return rows.withColumns(
        {
            "nofirst_key": F.md5(without_first_sentence(F.col("core_norm"))),
            "has_merge_tok": F.col("core_norm").rlike(vocab.MERGE_TOKEN_PATTERN),
            "core_words": F.size(words("core_norm")),
        }
    )


def variation_types(marked: DataFrame, least_size: int = vocab.DEFAULT_FAMILY_SIZE) -> DataFrame:
    """Exclusive type of variation per row; marked: labelled rows with mark_texts, no texts needed."""
    exact = marked.groupBy("text_key").agg(F.count(F.lit(1)).alias("fam_exact"))
    nofirst = marked.groupBy("nofirst_key").agg(F.count(F.lit(1)).alias("fam_nofirst"))
    kind = (
        F.when(F.col("fam_size") < least_size, "singleton_or_pair")
        .when((F.col("fam_exact") >= least_size) & F.col("has_merge_tok"), "exact_merge_template")
        .when(F.col("fam_exact") >= least_size, "exact_pure_blast")
        .when(F.col("fam_nofirst") >= least_size, "dynamic_first_line")
        .otherwise("near_dup_reorder_cta")
    )
    return marked.join(exact, "text_key").join(nofirst, "nofirst_key").withColumn("vtype", kind)


def _together(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct texts of families of two rows or more, and the key of each family's representative."""
    rows = labelled.where("fam_size >= 2")
    return rows.select("family", "text_key").distinct(), representative_keys(rows)


def family_drift(labelled: DataFrame, sets: DataFrame) -> DataFrame:
    """(text_key, drift_vs_rep): similarity to the representative of the family, once per distinct text.

    sets: shared_sets or text_sets, so that no text is read; labelled needs core_len.
    """
    texts, reps = _together(labelled)
    pairs = texts.join(reps, "family").select(F.col("text_key").alias("a"), F.col("rep_key").alias("b"))
    own = pairs.where("a = b").select(F.col("a").alias("text_key"), F.lit(1.0).alias("sim"))
    others = verify(pairs.where("a <> b"), sets, 0.0).select(F.col("a").alias("text_key"), "sim")
    return own.unionByName(others).select("text_key", F.round("sim", 3).alias("drift_vs_rep"))


def variation(
    labelled: DataFrame, least_size: int = vocab.DEFAULT_FAMILY_SIZE, drift: DataFrame | None = None
) -> DataFrame:
    """Exclusive type of variation per row, and its distance from the representative.

    labelled: with texts, or with mark_texts and the drift of family_drift.
    """
    rows = labelled if "nofirst_key" in labelled.columns else mark_texts(labelled)
    if drift is None:
        # each distinct text is compared with its representative once, not per row
        keyed = labelled.where("fam_size >= 2").groupBy("family", "text_key").agg(F.any_value("core_norm").alias("text"))
        reps = representatives(labelled, 2).select("family", F.col("text").alias("rep_text"))
        keyed = keyed.select("family", "text_key", hashed_shingles("text").alias("sh"))
        reps = reps.select("family", hashed_shingles("rep_text").alias("rep_sh"))
        drift = keyed.join(reps, "family").select(
            "text_key", F.round(jaccard(F.col("sh"), F.col("rep_sh")), 3).alias("drift_vs_rep")
        )
    text = [c for c in ("core_norm", "core_words") if c in rows.columns]
    return variation_types(rows, least_size).join(drift, "text_key", "left").select(
        "activity_id", "family", "text_key", "fam_size", "fam_exact", "fam_nofirst", "has_merge_tok", "vtype",
        "drift_vs_rep", *text, "is_reply",
    )


def variation_prevalence(varied: DataFrame) -> DataFrame:
    """Rows per type; their total comes from these few counts, not from the rows once more."""
    counts = varied.groupBy("vtype").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", rate(F.col("n"), F.sum("n").over(Window.partitionBy())))


def family_intensity(varied: DataFrame, least_size: int = vocab.DEFAULT_FAMILY_SIZE) -> DataFrame:
    """Per family: rows, distinct texts, worst distance from the representative."""
    return (
        varied.where(F.col("fam_size") >= least_size)
        .groupBy("family")
        .agg(
            F.count(F.lit(1)).alias("size"), F.count_distinct("text_key").alias("n_exact"),
            F.min("drift_vs_rep").alias("min_drift"),
        )
        .withColumn("variants_ratio", F.round(F.col("n_exact").cast("decimal(20,6)") / F.col("size"), 4))
    )


def nearest_representative(
    labelled: DataFrame, sets: DataFrame, least_size: int = vocab.DEFAULT_FAMILY_SIZE, below: int | None = None
) -> DataFrame:
    """Distinct texts with their most similar representative of another family.

    sets: shared_sets or text_sets, so that no text is read; labelled needs core_len. `below` leaves out
    the texts of families of so many rows or more.
    """
    sets = sets.select("text_key", "score", "n")
    asked = labelled if below is None else labelled.where(F.col("fam_size") < below)
    reps = representative_keys(labelled.where(F.col("fam_size") >= least_size))
    near = nearest_by_sets(
        sets.join(asked.select("text_key", "family").distinct(), "text_key"),
        sets.join(reps.withColumnRenamed("rep_key", "text_key"), "text_key"),
    )
    return near.withColumn("nearest_j", F.round("nearest_j", 3))


def near_misses(labelled: DataFrame, sets: DataFrame, low: float = 0.35, high: float = 0.5) -> DataFrame:
    """Rows outside the families that come close to one."""
    near = nearest_representative(labelled, sets, below=vocab.DEFAULT_FAMILY_SIZE)
    near = near.where((F.col("nearest_j") >= low) & (F.col("nearest_j") < high))
    rows = labelled.where(F.col("fam_size") < vocab.DEFAULT_FAMILY_SIZE).select("activity_id", "text_key")
    return rows.join(near, "text_key").select("activity_id", "nearest_family", "nearest_j")


# ------------------------------------------------------------------- stability
def replay(labelled: DataFrame, least_size: int = vocab.DEFAULT_FAMILY_SIZE) -> DataFrame:
    """Arrival rank in the family, label at birth and at the end, day the label settles."""
    rows = labelled.withColumn("day", F.col("occurred_at").cast("date"))
    ranked = rank_in_key(rows, ["family"], F.col("day"), [F.col("occurred_at"), F.col("activity_id")], out="arr_rank")
    settled = ranked.where(F.col("arr_rank") == least_size).select("family", F.col("day").alias("stab_day"))
    final = F.col("fam_size") >= least_size
    born = F.col("arr_rank") >= least_size
    return ranked.join(settled, "family", "left").select(
        "activity_id", "family", "day", "arr_rank", "stab_day",
        final.alias("final_templated"), born.alias("born_templated"), (final & ~born).alias("flips"),
        F.when(final & ~born, F.datediff("stab_day", "day")).alias("days_to_stability"),
    )


def flip_summary(replayed: DataFrame) -> DataFrame:
    return replayed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("flips").alias("flips"),
        F.round(F.avg("days_to_stability"), 3).alias("mean_days"),
        F.percentile("days_to_stability", F.lit(0.5)).alias("median_days"),
        F.percentile("days_to_stability", F.lit(0.9)).alias("p90_days"),
        F.count_if(F.col("days_to_stability") == 0).alias("same_day"),
    )


def daily_as_of(labelled: DataFrame, least_size: int = vocab.DEFAULT_FAMILY_SIZE) -> DataFrame:
    """Share still personalised if the label were frozen on each day.

    A family turns templated on the day its cumulative size first reaches the limit, and
    brings all rows it has by then. Working on (family, day) counts keeps the per-day
    recomputation down to two running sums.
    """
    daily = labelled.groupBy("family", F.col("occurred_at").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    by_day = Window.partitionBy("family").orderBy("day")
    upto = F.sum("n").over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    before = upto - F.col("n")
    gained = F.when(before >= least_size, F.col("n")).when(upto >= least_size, upto).otherwise(F.lit(0))
    per_day = (
        daily.withColumn("gained", gained)
        .groupBy("day")
        .agg(F.sum("n").alias("n"), F.sum("gained").alias("gained"))
    )
    run = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)  # one row per calendar day
    return per_day.select(
        "day", F.sum("n").over(run).alias("rows_to_date"), F.sum("gained").over(run).alias("templated_to_date")
    ).withColumn(
        "personalized_pct", rate(F.col("rows_to_date") - F.col("templated_to_date"), F.col("rows_to_date"))
    )


# ------------------------------------------------------------------ evaluation
def evaluate(labelled: DataFrame, truth: DataFrame, big_family: int = 10) -> DataFrame:
    """Agreement with hand labels (truth: activity_id, label, fam_sim).

    `fam_sim` is the family size the labelling saw; a missed message of a big one is a hard miss.
    """
    j = truth.join(labelled.select("activity_id", "pred", "fam_size"), "activity_id", "left")
    pt, tt = F.col("pred") == "Templated", F.col("label") == "Templated"
    pp, tp_ = F.col("pred") == "Personalized", F.col("label") == "Personalized"
    return j.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(pt & tt).alias("tp"), F.count_if(pp & tp_).alias("tn"),
        F.count_if(pt & tp_).alias("fp"), F.count_if(pp & tt).alias("fn"),
        F.count_if(pt & tp_).alias("hard_bespoke"),
        F.count_if(pp & tt & (F.col("fam_sim") >= big_family)).alias("hard_blast"),
    ).withColumn("accuracy", rate(F.col("tp") + F.col("tn"), F.col("n"), digits=2))


def disagreements(labelled: DataFrame, truth: DataFrame) -> DataFrame:
    return (
        truth.join(labelled.select("activity_id", "ca_name", "pred", "fam_size"), "activity_id", "left")
        .where(~F.col("pred").eqNullSafe(F.col("label")))
    )


def rep_reuse(labelled: DataFrame) -> DataFrame:
    """Per rep: rows, first messages, templated share overall, of first messages, of replies."""
    t, fresh = F.col("pred") == "Templated", ~F.col("is_reply")
    return (
        labelled.groupBy("ca_name")
        .agg(
            F.count(F.lit(1)).alias("n"), F.count_if(fresh).alias("fresh_n"),
            F.count_if(t).alias("_t"), F.count_if(t & fresh).alias("_tf"), F.count_if(t & ~fresh).alias("_tr"),
        )
        .select(
            "ca_name", "n", "fresh_n",
            rate(F.col("_t"), F.col("n")).alias("templated_pct"),
            rate(F.col("n") - F.col("_t"), F.col("n")).alias("personalized_pct"),
            rate(F.col("_tf"), F.col("fresh_n")).alias("fresh_templated_pct"),
            rate(F.col("_tr"), F.col("n") - F.col("fresh_n")).alias("reply_templated_pct"),
        )
    )


def sweep(
    corpus: DataFrame, truth: DataFrame, grid: Sequence[tuple[int, float]], sizes: Sequence[int],
    exact: bool = False, big_family: int = 10,
) -> DataFrame:
    """Metrics per (shingle length, threshold, family size); truth: activity_id, label, fam_sim.

    All cells are counted from one row per text. Without `exact` they share their pairs and all rounds (band_families);
    with it sets and the similarities of the first pass are built once per k, at its least threshold.
    """
    unique = stored(unique_texts(corpus))
    if exact:
        families, bands, by_k = [], None, {}
        for i, (k, threshold) in enumerate(grid):
            if k not in by_k:
                sets = shared_sets(unique, k)
                if bands is None:
                    bands = stored(close_keys(sets))
                by_k[k] = sets, stored(verify(star_pairs(bands), sets, min(t for j, t in grid if j == k)))
            sets, stars = by_k[k]
            found = connected_components(family_links(sets, threshold, bands=bands, stars=stars))
            families.append(found.select(F.lit(i).alias("cell"), F.col("node").alias("text_key"), F.col("component").alias("family")))
        linked = reduce(DataFrame.unionByName, families)
    else:
        linked = band_families(unique, grid)
    return _sweep_counts(corpus, truth, linked, grid, sizes, big_family)


def _sweep_counts(
    corpus: DataFrame, truth: DataFrame, linked: DataFrame, grid: Sequence[tuple[int, float]], sizes: Sequence[int], big_family: int
) -> DataFrame:
    """The sweep's metrics; linked: (cell, text_key, family) of texts that are not a family by themselves."""
    key = F.col("text_key") if "text_key" in corpus.columns else F.md5("core_norm").alias("text_key")
    rows = stored(corpus.select("activity_id", "is_reply", key).where("text_key IS NOT NULL"))
    copies = rows.groupBy("text_key").agg(F.count(F.lit(1)).alias("fam_size"))
    told = {"tp": F.col("label") == "Templated", "tn": F.col("label") == "Personalized"}
    told["blast"] = told["tp"] & (F.col("fam_sim") >= big_family)
    judged = rows.join(truth.select("activity_id", "label", "fam_sim"), "activity_id", "left")
    sums = {"n": F.lit(True), "fresh": ~F.col("is_reply"), **told}
    texts = stored(copies.join(judged.groupBy("text_key").agg(*[F.count_if(c).alias(x) for x, c in sums.items()]), "text_key"))
    total = [F.sum(x).alias(x) for x in sums]

    # A family counts by its size; its texts do so no longer by their own.
    own = stored(linked.join(texts, "text_key"))
    joined = own.groupBy("cell", "family").agg(F.sum("fam_size").alias("fam_size"), *total)
    cells = texts.sparkSession.createDataFrame([(i, k, float(t)) for i, (k, t) in enumerate(grid)], "cell int, k int, threshold double")
    alone = texts.groupBy("fam_size").agg(*total).join(F.broadcast(cells.select("cell")))
    less = own.groupBy("cell", "fam_size").agg(*[F.sum(-F.col(x)).alias(x) for x in sums])
    parts = [x.select("cell", "fam_size", *sums) for x in (alone, less, joined.groupBy("cell", "fam_size").agg(*total))]
    many = reduce(DataFrame.unionByName, parts).withColumn("least_size", F.explode(F.array(*[F.lit(s) for s in sizes])))

    def summed(x: str, big: bool) -> Column:
        t = F.col("fam_size") >= F.col("least_size")
        return F.sum(F.when(t if big else ~t, F.col(x)).otherwise(F.lit(0)))

    out = many.groupBy("cell", "least_size").agg(
        F.sum("n").alias("n"), summed("n", True).alias("templated"), summed("fresh", True).alias("fresh_templated"),
        summed("tp", True).alias("tp"), summed("tn", False).alias("tn"), summed("tn", True).alias("fp"),
        summed("tp", False).alias("fn"), summed("blast", False).alias("hard_blast"),
    )
    judged = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return out.join(F.broadcast(cells), "cell").select(
        "k", "threshold", *[c for c in out.columns if c != "cell"], rate(F.col("tp") + F.col("tn"), judged, digits=2).alias("accuracy")
    )


def normalization_ablation(
    messages: DataFrame, truth: DataFrame, own_domain: str, own_brand: str, exact: bool = False
) -> DataFrame:
    """The sweep's metrics with every normalisation step, and with each one switched off.

    Bodies are opened once. With `exact` all corpora go through one run: a mark at the head of every word keeps
    the texts of one corpus apart from those of the others, and leaves their similarities as they are.
    """
    grid, sizes = [(vocab.DEFAULT_SHINGLE_WORDS, vocab.DEFAULT_FAMILY_THRESHOLD)], [vocab.DEFAULT_FAMILY_SIZE]
    choices = (None, *STEPS)
    opened = stored(open_bodies(messages, own_domain).select(
        "activity_id", "ca_name", "contact_firstname", "contact_lastname", "account_name", "contact_jobtitle",
        "_full", "_head", "has_quote", "quote_internal",
    ))
    rows = [
        normalize_bodies(opened, own_domain, own_brand, [s for s in STEPS if s != off])
        .select(F.lit(i).alias("off"), "activity_id", "ca_name", "core_norm", "is_reply")
        for i, off in enumerate(choices)
    ]
    if not exact:
        parts = [sweep(stored(x), truth, grid, sizes) for x in rows]
    else:
        corpus = stored(reduce(DataFrame.unionByName, rows).withColumn("text_key", F.concat(F.col("off"), F.md5("core_norm"))))
        mark = F.col("off").cast("string")
        marked = F.when(F.col("core_norm") != "", F.concat(mark, F.replace("core_norm", F.lit(" "), F.concat(F.lit(" "), mark))))
        sets = shared_sets(unique_texts(corpus.select("text_key", marked.alias("core_norm"))), grid[0][0])
        found = stored(connected_components(family_links(sets, grid[0][1])))
        linked = found.select(F.lit(0).alias("cell"), F.col("node").alias("text_key"), F.col("component").alias("family"))
        parts = [
            _sweep_counts(corpus.where(F.col("off") == i), truth, linked.where(F.col("text_key").startswith(str(i))), grid, sizes, 10)
            for i in range(len(choices))
        ]
    return reduce(DataFrame.unionByName, [x.select(F.lit(off or "none").alias("switched_off"), "*") for off, x in zip(choices, parts, strict=True)])


# --------------------------------------------------------------------- samples
def stratified_sample(rows: DataFrame, stratum: str, quota: dict[str, int], key: str = "activity_id", seed: int = 42) -> DataFrame:
    """A fixed number of rows per stratum, chosen by the order of md5(seed:key): repeatable.

    Only rows that can still make the quota leave a partition-level cut: candidates are
    first thinned per (stratum, hash slice), so no stratum is sorted in one task.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    wanted = F.create_map(*[F.lit(x) for kv in quota.items() for x in kv])
    rows = rows.where(F.col(stratum).isin(*quota)).withColumns({"_h": order, "_q": wanted[F.col(stratum)]})
    rows = rows.withColumn("_slice", F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(64)))
    local = Window.partitionBy(stratum, "_slice").orderBy("_h", key)
    rows = rows.withColumn("_rn", F.row_number().over(local)).where("_rn <= _q")
    final = Window.partitionBy(stratum).orderBy("_h", key)
    rows = rows.withColumn("_rn", F.row_number().over(final)).where("_rn <= _q")
    return rows.drop("_h", "_q", "_slice", "_rn")


def adjudication_sample(varied: DataFrame, quota: dict[str, int], extras: int, short_words: int = 15, seed: int = 42) -> DataFrame:
    """The rows to label by hand: a quota per type of variation, and two kinds of hard cases.

    The extras are short texts, and replies, outside the families; a row is taken once.
    """
    alone = F.col("fam_size") < vocab.DEFAULT_FAMILY_SIZE
    n_words = (F.col("core_words") if "core_words" in varied.columns else F.size(words("core_norm"))).alias("_words")
    varied = stored(varied.select("activity_id", "vtype", "fam_size", "is_reply", n_words))
    picks = stratified_sample(varied, "vtype", quota, seed=seed).select("activity_id", "vtype")
    for kind in (F.col("_words") < short_words, F.col("is_reply")):
        pool = varied.where(kind & alone).withColumn("_kind", F.lit("extra"))
        picks = picks.unionByName(stratified_sample(pool, "_kind", {"extra": extras}, seed=seed).select("activity_id", "vtype"))
    return picks.distinct()


def holdout_sample(labelled: DataFrame, seen: DataFrame, quota: dict[str, int], seed: int = 42) -> DataFrame:
    """Fresh rows, stratified by prediction and family-size band, none of them seen before."""
    size = F.col("fam_size")
    band = F.when(size <= 1, "1").when(size <= 2, "2").when(size <= 9, "3-9").otherwise("10+")
    pool = labelled.join(seen.select("activity_id"), "activity_id", "left_anti")
    pool = pool.withColumn("stratum", F.concat_ws("/", "pred", band))
    return stratified_sample(pool, "stratum", quota, seed=seed)


# --------------------------------------------------------------------- profile
def corpus_profile(corpus: DataFrame, quantiles: Sequence[float] = (0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95)) -> DataFrame:
    """Flag rates, empty cores and word-count quantiles of a normalised corpus."""
    n = F.count(F.lit(1))
    flags = [f for f in ("has_quote", "is_reply", "is_selfbump", "sig_removed", "disc_removed") if f in corpus.columns]
    return corpus.agg(
        n.alias("rows"),
        *[rate(F.count_if(f), n).alias(f"{f}_pct") for f in flags],
        F.count_if(F.col("core_words") <= 2).alias("short_cores"),
        F.count_if(F.col("core_len") == 0).alias("empty_cores"),
        *[F.percentile("core_words", F.lit(q)).alias(f"words_p{int(q * 100):02d}") for q in quantiles],
    )
