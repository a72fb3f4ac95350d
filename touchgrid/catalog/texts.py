"""Registered text-reuse queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchgrid import vocab
from touchgrid.catalog.registry import query
from touchgrid.functions import text as tx
from touchgrid.functions.html import html_to_text
from touchgrid.operators import similarity as sim
from touchgrid.plans import reuse
from touchgrid.session import stored

WS = "[\\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
CORPUS_SQL = """
SELECT CAST(doc_id AS STRING) AS activity_id, source AS ca_name, lang IN ('de', 'fr') AS is_reply,
       'p' || CAST(doc_id % 211 AS STRING) || '@example.org' AS contact_email,
       TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '20' MINUTE * doc_id AS occurred_at, text
FROM {documents}
"""
TRUTH_SQL = """SELECT CAST(doc_id AS STRING) AS activity_id,
  CASE WHEN quality = 1 THEN 'Personalized' ELSE 'Templated' END AS label,
  CAST(1 + doc_id % 20 AS INT) AS fam_sim FROM {labels}"""


def sh_sql(w: str, k: int = 4) -> str:
    """Distinct k-word windows of a word list (DuckDB)."""
    gram = " || ' ' || ".join(f"{w}[i + {j}]" if j else f"{w}[i]" for j in range(k))
    return (
        f"CASE WHEN {w} = [''] THEN [] WHEN len({w}) < {k} THEN [array_to_string({w}, ' ')] "
        f"ELSE list_distinct(list_transform(range(1, len({w}) - {k} + 2), lambda i: {gram})) END"
    )


T_VIEWS = {
    "corpus": f"""SELECT *, md5(core_norm) AS text_key FROM (SELECT activity_id, ca_name, is_reply, contact_email, occurred_at,
        regexp_replace(trim(regexp_replace(lower(text), '{WS}', ' ', 'g')), '\\s+([,.!?;:])', '\\1', 'g') AS core_norm
        FROM ({CORPUS_SQL}))""",
    "truth": TRUTH_SQL,
    "uniq": "SELECT text_key, any_value(core_norm) AS txt, count(*) AS copies FROM {corpus} GROUP BY 1",
    "split": "SELECT text_key, txt, string_split(txt, ' ') AS w FROM {uniq}",
    "sets": f"SELECT text_key, txt, {sh_sql('w')} AS sh FROM {{split}}",
    "toks": "SELECT text_key, n, hash(w) AS tok FROM (SELECT text_key, len(sh) AS n, unnest(sh) AS w FROM {sets})",
    "shared": "SELECT t.* FROM {toks} t JOIN (SELECT tok FROM {toks} GROUP BY 1 HAVING count(*) > 1) d ON d.tok = t.tok",
    "pairs": """SELECT a, b, c / (na + nb - c) AS sim FROM (SELECT x.text_key AS a, y.text_key AS b, x.n AS na, y.n AS nb, count(*) AS c
        FROM {shared} x JOIN {shared} y ON x.tok = y.tok AND x.text_key < y.text_key GROUP BY ALL) WHERE c / (na + nb - c) >= 0.45""",
    "ways": "SELECT a, b FROM {pairs} UNION ALL SELECT b, a FROM {pairs}",
    "reach": "SELECT text_key, text_key AS other FROM {uniq} UNION SELECT r.text_key, w.b FROM reach r JOIN {ways} w ON w.a = r.other",
    "fams": "SELECT text_key, min(other) AS family FROM {reach} GROUP BY 1",
    "sized": "SELECT c.*, f.family, count(*) OVER (PARTITION BY f.family) AS fam_size FROM {corpus} c JOIN {fams} f ON f.text_key = c.text_key",
    "labelled": "SELECT *, CASE WHEN fam_size >= 3 THEN 'Templated' ELSE 'Personalized' END AS pred FROM {sized}",
    "reps": """SELECT family, core_norm AS txt, text_key, fam_size FROM (SELECT *, row_number() OVER (PARTITION BY family
        ORDER BY length(core_norm) DESC, text_key) AS rn FROM {labelled}) WHERE rn = 1""",
    "varied0": """SELECT *, count(*) OVER (PARTITION BY text_key) AS fam_exact, count(*) OVER (PARTITION BY nofirst) AS fam_nofirst FROM (
        SELECT *, regexp_matches(core_norm, '<(fn|ln|acct|title|url|email)>') AS has_merge_tok,
          CASE WHEN length(regexp_extract(core_norm, '(?s)^.*?[.!?]\\s+(.*)$', 1)) > 20
               THEN regexp_extract(core_norm, '(?s)^.*?[.!?]\\s+(.*)$', 1) ELSE core_norm END AS nofirst FROM {labelled})""",
    "drift": f"""SELECT DISTINCT s.text_key, CAST(round(len(list_intersect(s.sh, r.sh)) /
          (len(s.sh) + len(r.sh) - len(list_intersect(s.sh, r.sh))), 3) AS DOUBLE) AS drift
        FROM {{sets}} s JOIN {{fams}} f ON f.text_key = s.text_key
        JOIN (SELECT p.family, t.sh FROM {{reps}} p JOIN {{sets}} t ON t.text_key = p.text_key WHERE p.fam_size >= 2) r ON r.family = f.family""",
    "varied": """SELECT v.*, d.drift AS drift_vs_rep, CASE WHEN fam_size < 3 THEN 'singleton_or_pair'
          WHEN fam_exact >= 3 AND has_merge_tok THEN 'exact_merge_template' WHEN fam_exact >= 3 THEN 'exact_pure_blast'
          WHEN fam_nofirst >= 3 THEN 'dynamic_first_line' ELSE 'near_dup_reorder_cta' END AS vtype
        FROM {varied0} v LEFT JOIN {drift} d ON d.text_key = v.text_key""",
    "near": """SELECT text_key, arg_min(rep, (-j, rep)) AS nearest_family, CAST(round(max(j), 3) AS DOUBLE) AS nearest_j FROM (
        SELECT t.text_key, r.family AS rep, count(*) / (any_value(t.n) + any_value(x.n) - count(*)) AS j
        FROM {toks} t JOIN {fams} f ON f.text_key = t.text_key JOIN {toks} x ON x.tok = t.tok
        JOIN {reps} r ON r.text_key = x.text_key AND r.fam_size >= 3 AND r.family <> f.family GROUP BY ALL) GROUP BY 1""",
    "replayed": """SELECT *, row_number() OVER (PARTITION BY family ORDER BY occurred_at, activity_id) AS arr_rank,
        CAST(occurred_at AS DATE) AS day FROM {labelled}""",
    "replayed2": """SELECT r.*, s.day AS stab_day, r.fam_size >= 3 AS final_templated, r.arr_rank >= 3 AS born_templated,
        r.fam_size >= 3 AND r.arr_rank < 3 AS flips,
        CASE WHEN r.fam_size >= 3 AND r.arr_rank < 3 THEN date_diff('day', r.day, s.day) END AS days_to_stability
        FROM {replayed} r LEFT JOIN (SELECT family, day FROM {replayed} WHERE arr_rank = 3) s ON s.family = r.family""",
}


# ---- Spark-side inputs -----------------------------------------------------------
def core(c):
    # Squeezed white space is single blanks, so the trim and the marks need no pattern.
    c = F.trim(tx.squeeze(F.lower(c)))
    for mark in ",.!?;:":
        c = F.replace(c, F.lit(" " + mark), F.lit(mark))
    return c


def corpus(t):
    return t.sql(CORPUS_SQL).withColumn("core_norm", core(F.col("text"))).drop("text")


def keyed(t):
    """The corpus with the key of each text, normalised and written once."""
    if "_keyed" not in t.memo:
        t.memo["_keyed"] = stored(corpus(t).withColumns({"text_key": F.md5("core_norm"), "core_len": F.length("core_norm")}))
    return t.memo["_keyed"]


def sets(t):
    """Of each text the windows other texts have too: families and distances read these, not the texts."""
    if "_sets" not in t.memo:
        t.memo["_sets"] = sim.shared_sets(sim.unique_texts(keyed(t)), vocab.DEFAULT_SHINGLE_WORDS)
    return t.memo["_sets"]


def families(t):
    if "_fam" not in t.memo:
        t.memo["_fam"] = stored(sim.linked_families(sets(t), sim.family_links(sets(t))))
    return t.memo["_fam"]


def labelled(t):
    """Labels of all rows, without their texts."""
    if "_labelled" not in t.memo:
        t.memo["_labelled"] = stored(reuse.label_corpus(keyed(t).drop("core_norm"), families=families(t)))
    return t.memo["_labelled"]


def worded(t):
    """Labels of all rows with their texts."""
    if "_worded" not in t.memo:
        t.memo["_worded"] = stored(reuse.label_corpus(keyed(t), families=families(t)))
    return t.memo["_worded"]


def marked(t):
    """Labels of all rows with what the types of variation read of their texts, which stay where they are."""
    if "_marked" not in t.memo:
        rows = reuse.mark_texts(keyed(t)).drop("core_norm")
        t.memo["_marked"] = stored(reuse.label_corpus(rows, families=families(t)))
    return t.memo["_marked"]


def truth(t):
    return t.sql(TRUTH_SQL)


def messages(t):
    """Pages as message bodies, with merge values taken from words of the same page."""
    return t["pages"].select(
        F.col("page_id").cast("string").alias("activity_id"), F.col("html").alias("body_html"),
        F.concat(F.lit("Rep "), F.col("page_id").cast("string")).alias("ca_name"),
        F.regexp_extract("html", r"<title>(\w+)", 1).alias("contact_firstname"),
        F.regexp_extract("html", r"<title>\S+ (\w+)", 1).alias("contact_lastname"),
        F.regexp_extract("url", r"//([^/]+)/", 1).alias("account_name"),
        F.lit("Head of Data").alias("contact_jobtitle"),
    )


def normalized(t):
    return reuse.with_counts(reuse.normalize_bodies(messages(t), "corp.example.com", "corp"))


# ---- normalisation ---------------------------------------------------------------
@query("page_text", "B19")
def _(t):
    return t["pages"].select("page_id", html_to_text("html").alias("text"))


@query("page_preview", "B20", f"""
SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '{WS}', ' ', 'g')) AS preview FROM {{pages}}""")
def _(t):
    return t["pages"].select("page_id", tx.preview_text(F.lit(""), "html").alias("preview"))


@query("normalized_messages", "I1 I2 I3 I4 I5")
def _(t):
    return normalized(t).select(
        "activity_id", "core", "core_norm", "has_quote", "quote_internal", "is_reply", "is_selfbump",
        "sig_removed", "disc_removed",
    )


@query("text_counts", "B24", """
SELECT activity_id, length(core_norm) AS core_len, CASE WHEN core_norm = '' THEN 0 ELSE len(string_split(core_norm, ' ')) END AS core_words
FROM {corpus}""", T_VIEWS)
def _(t):
    return reuse.with_counts(corpus(t)).select("activity_id", "core_len", "core_words")


@query("corpus_profile", "I22", """
SELECT count(*) AS rows, CAST(round(100.0 * count(*) FILTER (WHERE is_reply) / count(*), 1) AS DOUBLE) AS is_reply_pct,
  count(*) FILTER (WHERE w <= 2) AS short_cores, count(*) FILTER (WHERE core_norm = '') AS empty_cores, """ + ", ".join(
    f"CAST(quantile_cont(w, {q}) AS DOUBLE) AS words_p{int(q * 100):02d}" for q in (0.25, 0.5, 0.75)) + """
FROM (SELECT *, CASE WHEN core_norm = '' THEN 0 ELSE len(string_split(core_norm, ' ')) END AS w FROM {corpus})""", T_VIEWS)
def _(t):
    return reuse.corpus_profile(reuse.with_counts(corpus(t)), (0.25, 0.5, 0.75))


# ---- similarity ------------------------------------------------------------------
@query("text_shingles", "I6", "SELECT text_key, len(sh) AS n, md5(array_to_string(list_sort(sh), '|')) AS h FROM {sets}", T_VIEWS)
def _(t):
    s = sim.unique_texts(corpus(t)).select("text_key", F.array_sort(sim.shingles("text")).alias("sh"))
    return s.select("text_key", F.size("sh").alias("n"), F.md5(F.array_join("sh", "|")).alias("h"))


@query("exact_duplicates", "I11", "SELECT text_key, copies FROM {uniq}", T_VIEWS)
def _(t):
    return sim.unique_texts(corpus(t)).select("text_key", "copies")


P = vocab.MINHASH_PRIME
PERMUTED = ", ".join(f"list_min(list_transform(h, lambda x: (x * {a} + {b}) % {P}))" for a, b in sim.minhash_coefficients())
BAND_ROWS = vocab.MINHASH_PERMUTATIONS // vocab.MINHASH_BANDS
LSH_VIEWS = {
    **T_VIEWS,
    "hashed": f"""SELECT text_key, list_transform(sh, lambda w: CAST('0x' || left(md5(w), 15) AS BIGINT) % {P}) AS h FROM {{sets}}""",
    "signed": f"""SELECT text_key, CASE WHEN len(h) = 0 THEN list_transform(range({vocab.MINHASH_PERMUTATIONS}), lambda i: CAST(0 AS BIGINT))
        ELSE [{PERMUTED}] END AS sig FROM {{hashed}}""",
    "banded": f"""SELECT text_key, md5(CAST(b AS STRING) || ',' || array_to_string(sig[b * {BAND_ROWS} + 1:b * {BAND_ROWS} + {BAND_ROWS}], ',')) AS key
        FROM (SELECT text_key, sig, unnest(range({vocab.MINHASH_BANDS})) AS b FROM {{signed}})""",
    "band_pairs": """SELECT DISTINCT x.text_key AS a, y.text_key AS b FROM {banded} x JOIN {banded} y
        ON x.key = y.key AND x.text_key < y.text_key""",
    "band_links": """SELECT a, b FROM (SELECT p.a, p.b, len(list_intersect(s.sh, r.sh)) AS c, len(s.sh) AS m, len(r.sh) AS n
        FROM {band_pairs} p JOIN {sets} s ON s.text_key = p.a JOIN {sets} r ON r.text_key = p.b)
        WHERE m + n = c OR c / (m + n - c) >= 0.45""",
    "band_ways": "SELECT a, b FROM {band_links} UNION ALL SELECT b, a FROM {band_links}",
    "band_reach": """SELECT text_key, text_key AS other FROM {uniq}
        UNION SELECT r.text_key, w.b FROM band_reach r JOIN {band_ways} w ON w.a = r.other""",
}


@query("minhash_signatures", "I7", "SELECT text_key, md5(array_to_string(sig, ',')) AS signature_md5 FROM {signed}", LSH_VIEWS)
def _(t):
    s = stored(sim.text_sets(sim.unique_texts(corpus(t)), 4))
    signed = s.select("text_key", sim.minhash(F.col("block")).cast("array<string>").alias("signature"))
    return signed.select("text_key", F.md5(F.array_join("signature", ",")).alias("signature_md5"))


@query("lsh_bands", "I8", "SELECT text_key, key FROM {banded}", LSH_VIEWS)
def _(t):
    return sim.band_keys(stored(sim.text_sets(sim.unique_texts(corpus(t)), 4)))


@query("text_families_lsh", "I7 I8 I9 I10 I11", "SELECT text_key, min(other) AS family FROM {band_reach} GROUP BY 1", LSH_VIEWS)
def _(t):
    return sim.text_families(sim.unique_texts(corpus(t)))


@query("text_families_exact", "I9 I10 I11", "SELECT text_key, family FROM {fams}", T_VIEWS)
def _(t):
    return families(t)


@query("text_families_length_aware", "I13", "SELECT text_key, min(other) AS family FROM {reach_la} GROUP BY 1", {
    **T_VIEWS,
    "wn": "SELECT text_key, CASE WHEN txt = '' THEN 0 ELSE len(string_split(txt, ' ')) END AS w FROM {uniq}",
    "pairs_la": """SELECT a, b FROM (SELECT x.text_key AS a, y.text_key AS b, x.n AS na, y.n AS nb, count(*) AS c
        FROM {shared} x JOIN {shared} y ON x.tok = y.tok AND x.text_key < y.text_key GROUP BY ALL)
        JOIN {wn} p ON p.text_key = a JOIN {wn} q ON q.text_key = b
        WHERE c / (na + nb - c) >= CASE WHEN least(p.w, q.w) < 25 THEN 0.35 ELSE 0.45 END""",
    "ways_la": "SELECT a, b FROM {pairs_la} UNION ALL SELECT b, a FROM {pairs_la}",
    "reach_la": "SELECT text_key, text_key AS other FROM {uniq} UNION SELECT r.text_key, w.b FROM reach_la r JOIN {ways_la} w ON w.a = r.other"})
def _(t):
    return sim.text_families(sim.unique_texts(corpus(t)), exact=True, length_aware=True)


# ---- labels and analysis ------------------------------------------------------------
@query("template_labels", "I12 G4", "SELECT activity_id, family, fam_size, pred FROM {labelled}", T_VIEWS)
def _(t):
    return labelled(t).select("activity_id", "family", "fam_size", "pred")


@query("template_labels_by_recipients", "I12", """
SELECT c.activity_id, s.n AS fam_size, CASE WHEN s.n >= 3 THEN 'Templated' ELSE 'Personalized' END AS pred FROM {labelled} c
JOIN (SELECT family, count(DISTINCT contact_email) AS n FROM {labelled} GROUP BY 1) s ON s.family = c.family""", T_VIEWS)
def _(t):
    return reuse.label_corpus(keyed(t).drop("core_norm"), families=families(t), count_recipients=True).select("activity_id", "fam_size", "pred")


@query("family_representatives", "G6", "SELECT family, text_key AS rep_key FROM {reps}", T_VIEWS)
def _(t):
    return reuse.representative_keys(labelled(t))


@query("variation_types", "I15 G4", """
SELECT activity_id, vtype, fam_exact, fam_nofirst, has_merge_tok, drift_vs_rep FROM {varied}""", T_VIEWS)
def _(t):
    varied = reuse.variation(marked(t), drift=reuse.family_drift(marked(t), sets(t)))
    return varied.select("activity_id", "vtype", "fam_exact", "fam_nofirst", "has_merge_tok", "drift_vs_rep")


@query("variation_prevalence", "I15", """
SELECT vtype, count(*) AS n, CAST(round(100.0 * count(*) / (SELECT count(*) FROM {varied}), 1) AS DOUBLE) AS pct
FROM {varied} GROUP BY 1""", T_VIEWS)
def _(t):
    return reuse.variation_prevalence(reuse.variation_types(marked(t)))


@query("family_intensity", "I15", """
SELECT family, count(*) AS size, count(DISTINCT text_key) AS n_exact, min(drift_vs_rep) AS min_drift,
  CAST(round(CAST(count(DISTINCT text_key) AS DECIMAL(18,6)) / count(*), 4) AS DOUBLE) AS variants_ratio
FROM {varied} WHERE fam_size >= 3 GROUP BY 1""", T_VIEWS)
def _(t):
    return reuse.family_intensity(labelled(t).join(reuse.family_drift(labelled(t), sets(t)), "text_key", "left"))


@query("nearest_representative", "I20", """
SELECT u.text_key, n.nearest_family, coalesce(n.nearest_j, 0.0) AS nearest_j FROM {uniq} u LEFT JOIN {near} n ON n.text_key = u.text_key""", T_VIEWS)
def _(t):
    return reuse.nearest_representative(labelled(t), sets(t))


@query("near_misses", "I20", """
SELECT l.activity_id, n.nearest_family, n.nearest_j FROM {labelled} l JOIN {near} n ON n.text_key = l.text_key
WHERE l.fam_size < 3 AND n.nearest_j >= 0.02 AND n.nearest_j < 0.5""", T_VIEWS)
def _(t):
    return reuse.near_misses(labelled(t), sets(t), low=0.02)


@query("arrival_replay", "I16 G3 G5 G10", """
SELECT activity_id, CAST(day AS STRING) AS day, arr_rank, CAST(stab_day AS STRING) AS stab_day, final_templated, born_templated,
  flips, days_to_stability FROM {replayed2}""", T_VIEWS)
def _(t):
    return reuse.replay(labelled(t)).drop("family")


@query("flip_summary", "I16", """
SELECT count(*) AS rows, count(*) FILTER (WHERE flips) AS flips, round(avg(days_to_stability), 3) AS mean_days,
  CAST(quantile_cont(days_to_stability, 0.5) AS DOUBLE) AS median_days, CAST(quantile_cont(days_to_stability, 0.9) AS DOUBLE) AS p90_days,
  count(*) FILTER (WHERE days_to_stability = 0) AS same_day FROM {replayed2}""", T_VIEWS)
def _(t):
    return reuse.flip_summary(reuse.replay(labelled(t)))


@query("daily_as_of_rate", "I16 G10", """
SELECT CAST(d.day AS STRING) AS day, CAST(count(*) AS BIGINT) AS rows_to_date, count(*) FILTER (WHERE s.n >= 3) AS templated_to_date,
  CAST(round(100.0 * count(*) FILTER (WHERE s.n < 3) / count(*), 1) AS DOUBLE) AS personalized_pct
FROM (SELECT DISTINCT day FROM {replayed}) d JOIN {replayed} r ON r.day <= d.day
JOIN (SELECT x.day, y.family, count(*) AS n FROM (SELECT DISTINCT day FROM {replayed}) x JOIN {replayed} y ON y.day <= x.day GROUP BY 1, 2) s
  ON s.day = d.day AND s.family = r.family GROUP BY d.day""", T_VIEWS)
def _(t):
    return reuse.daily_as_of(labelled(t))


@query("label_evaluation", "I17", """
SELECT count(*) AS n, count(*) FILTER (WHERE pred = 'Templated' AND label = 'Templated') AS tp,
  count(*) FILTER (WHERE pred = 'Personalized' AND label = 'Personalized') AS tn,
  count(*) FILTER (WHERE pred = 'Templated' AND label = 'Personalized') AS fp,
  count(*) FILTER (WHERE pred = 'Personalized' AND label = 'Templated') AS fn,
  count(*) FILTER (WHERE pred = 'Templated' AND label = 'Personalized') AS hard_bespoke,
  count(*) FILTER (WHERE pred = 'Personalized' AND label = 'Templated' AND fam_sim >= 10) AS hard_blast,
  CAST(round(100.0 * count(*) FILTER (WHERE pred = label) / count(*), 2) AS DOUBLE) AS accuracy
FROM {truth} t LEFT JOIN {labelled} l ON l.activity_id = t.activity_id""", T_VIEWS)
def _(t):
    return reuse.evaluate(labelled(t), truth(t))


@query("label_disagreements", "I18", """
SELECT t.activity_id, t.label, t.fam_sim, l.ca_name, l.pred, l.fam_size FROM {truth} t LEFT JOIN {labelled} l ON l.activity_id = t.activity_id
WHERE l.pred IS DISTINCT FROM t.label""", T_VIEWS)
def _(t):
    return reuse.disagreements(labelled(t), truth(t))


@query("rep_reuse_rates", "I19", """
SELECT ca_name, count(*) AS n, count(*) FILTER (WHERE NOT is_reply) AS fresh_n,
  CAST(round(100.0 * count(*) FILTER (WHERE pred = 'Templated') / count(*), 1) AS DOUBLE) AS templated_pct,
  CAST(round(100.0 * count(*) FILTER (WHERE pred <> 'Templated') / count(*), 1) AS DOUBLE) AS personalized_pct,
  CAST(round(100.0 * count(*) FILTER (WHERE pred = 'Templated' AND NOT is_reply) / nullif(count(*) FILTER (WHERE NOT is_reply), 0), 1) AS DOUBLE) AS fresh_templated_pct,
  CAST(round(100.0 * count(*) FILTER (WHERE pred = 'Templated' AND is_reply) / nullif(count(*) FILTER (WHERE is_reply), 0), 1) AS DOUBLE) AS reply_templated_pct
FROM {labelled} GROUP BY 1""", T_VIEWS)
def _(t):
    return reuse.rep_reuse(labelled(t))


@query("threshold_sweep", "I14", """
SELECT CAST(4 AS BIGINT) AS k, CAST(0.45 AS DOUBLE) AS threshold, CAST(s AS BIGINT) AS least_size, count(*) AS n,
  count(*) FILTER (WHERE fam_size >= s) AS templated, count(*) FILTER (WHERE fam_size >= s AND NOT is_reply) AS fresh_templated,
  count(*) FILTER (WHERE fam_size >= s AND label = 'Templated') AS tp, count(*) FILTER (WHERE fam_size < s AND label = 'Personalized') AS tn,
  count(*) FILTER (WHERE fam_size >= s AND label = 'Personalized') AS fp, count(*) FILTER (WHERE fam_size < s AND label = 'Templated') AS fn,
  count(*) FILTER (WHERE fam_size < s AND label = 'Templated' AND fam_sim >= 10) AS hard_blast,
  CAST(round(100.0 * count(*) FILTER (WHERE (fam_size >= s) = (label = 'Templated')) / count(label), 2) AS DOUBLE) AS accuracy
FROM (SELECT l.*, t.label, t.fam_sim, unnest([2, 3, 4, 5]) AS s FROM {labelled} l LEFT JOIN {truth} t ON t.activity_id = l.activity_id) GROUP BY s""", T_VIEWS)
def _(t):
    return reuse.sweep(corpus(t), truth(t), [(4, 0.45)], [2, 3, 4, 5], exact=True)


SWEEP = [(k, threshold) for k in (1, 3, 4, 5) for threshold in (0.3, 0.4, 0.45, 0.5, 0.55, 0.6, 0.7)]


@query("measure_sweep", "I14")
def _(t):
    return reuse.sweep(corpus(t), truth(t), SWEEP, [3])


@query("normalization_ablation", "I14 I1 I2 I3 I4 I5")
def _(t):
    return reuse.normalization_ablation(messages(t), truth(t), "corp.example.com", "corp", exact=True)


QUOTA = {
    "singleton_or_pair": 75, "exact_pure_blast": 25, "exact_merge_template": 25, "near_dup_reorder_cta": 40, "dynamic_first_line": 22,
}
HOLDOUT = {"Templated/2": 4, "Templated/3-9": 18, "Templated/10+": 18, "Personalized/1": 30, "Personalized/2": 8}


def quota_sql(rows: str, stratum: str, quota: dict[str, int]) -> str:
    """The first rows of each stratum by the order of md5(seed:key)."""
    wanted = "map {" + ", ".join(f"'{k}': {n}" for k, n in quota.items()) + "}"
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY md5('42:' || activity_id), activity_id) AS place
        FROM {rows}) WHERE place <= {wanted}[{stratum}]"""


SAMPLE_VIEWS = {
    **T_VIEWS,
    "alone": "SELECT *, 'extra' AS kind FROM {varied} WHERE fam_size < 3",
    "short_ones": "SELECT * FROM {alone} WHERE core_norm = '' OR len(string_split(core_norm, ' ')) < 15",
    "replies": "SELECT * FROM {alone} WHERE is_reply",
    "pool": """SELECT *, pred || '/' || CASE WHEN fam_size <= 1 THEN '1' WHEN fam_size <= 2 THEN '2' WHEN fam_size <= 9 THEN '3-9' ELSE '10+' END AS stratum
        FROM {labelled} WHERE activity_id NOT IN (SELECT activity_id FROM {truth})""",
}


@query("stratified_sample", "I21", f"""
SELECT activity_id, vtype FROM ({quota_sql('{varied}', 'vtype', QUOTA)})
UNION SELECT activity_id, vtype FROM ({quota_sql('{short_ones}', 'kind', {'extra': 15})})
UNION SELECT activity_id, vtype FROM ({quota_sql('{replies}', 'kind', {'extra': 15})})""", SAMPLE_VIEWS)
def _(t):
    return reuse.adjudication_sample(reuse.variation_types(marked(t)), QUOTA, 15)


@query("holdout_sample", "I21", f"SELECT activity_id, stratum FROM ({quota_sql('{pool}', 'stratum', HOLDOUT)})", SAMPLE_VIEWS)
def _(t):
    return reuse.holdout_sample(labelled(t), truth(t), HOLDOUT).select("activity_id", "stratum")
