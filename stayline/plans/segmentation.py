"""Clusters from fixed centroids, their metrics, profiles and cards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators import cluster_metrics as cm
from stayline.operators import metrics, score, segment, silhouette
from stayline.operators.cluster_metrics import assign_nearest, fit_centroids
from stayline.operators.dense import group_centroids
from stayline.operators.ranks import exact_quantiles, prefix_sums
from stayline.operators.scaling import apply_minmax, fit_minmax, log_scale
from stayline.plans.base import (
    CLEAN,
    CLUSTERED,
    DIST_SQL,
    RAW_SCORE,
    SCALED,
    SCORED,
    clean_customers,
    clean_table,
    clustered_customers,
    query,
    raw_score,
    scaled_customers,
    scored_customers,
    table,
    z_names,
)
from stayline.plans.evaluation import _rounded
from stayline.schema import FEATURES_8
from stayline.session import materialize
from stayline.sources.readers import explode_cards, parse_cards
from stayline.sources.writers import nest_cards

DIMS = 64  # components of an embedding
Z = z_names()
_Z_ROUND = ", ".join(f"round({z}, 6) AS {z}" for z in Z)


@query(f"WITH {SCALED} SELECT customer_id, {_Z_ROUND} FROM scaled")
def standard_scaled(spark, sf) -> DataFrame:
    return _rounded(scaled_customers(spark, sf).select("customer_id", *Z), *Z)


_MINMAX = ", ".join(
    f"round(coalesce(({f} - min({f}) OVER ())::DOUBLE / nullif(max({f}) OVER () - min({f}) OVER (), 0), 0), 6) AS {f}"
    for f in FEATURES_8
)


@query(f"WITH {CLEAN} SELECT customer_id, {_MINMAX} FROM clean")
def minmax_scaled(spark, sf) -> DataFrame:
    df = clean_table(spark, sf).select("customer_id", *FEATURES_8)
    return _rounded(apply_minmax(df, fit_minmax(df, FEATURES_8)), *FEATURES_8)


@query(
    f"""WITH {CLEAN} SELECT customer_id, round(ln(1 + greatest(monthly_charges, 0)), 6) AS monthly_charges,
    round(ln(1 + greatest(total_charges, 0)), 6) AS total_charges FROM clean"""
)
def log_scaled(spark, sf) -> DataFrame:
    df = clean_customers(spark, sf).select("customer_id", "monthly_charges", "total_charges")
    return _rounded(log_scale(df, ["monthly_charges", "total_charges"]), "monthly_charges", "total_charges")


@query(f"WITH {CLUSTERED} SELECT customer_id, cluster_id, round(sq_distance, 6) AS sq_distance FROM clus")
def nearest_cluster(spark, sf) -> DataFrame:
    return _rounded(
        clustered_customers(spark, sf).select("customer_id", "cluster_id", "sq_distance"), "sq_distance"
    )


_MEANS = ", ".join(
    f"round_even(CAST(sum(CAST({f} AS DECIMAL(28,6))) AS DOUBLE) / count(*), 3) AS mean_{f}" for f in FEATURES_8
)
_RISK = "CASE WHEN avg(churn) >= 0.5 THEN 'ALTO RISCO' ELSE 'BAIXO RISCO' END"


@query(
    f"""WITH {CLUSTERED} SELECT cluster_id, count(*) AS n_samples, round_even(avg(churn), 4) AS churn_rate,
    {_RISK} AS risk_label, {_MEANS} FROM clus GROUP BY cluster_id"""
)
def cluster_profiles(spark, sf) -> DataFrame:
    return segment.profile_clusters(clustered_customers(spark, sf))


_PROFILES = f"""
stats AS (SELECT segmento, cluster_id, count(*) AS n_amostras, round_even(avg(churn), 4) AS churn_rate,
                 {_RISK} AS risk_level, {_MEANS} FROM clus GROUP BY segmento, cluster_id),
prof AS (SELECT *, round_even(n_amostras / sum(n_amostras) OVER (PARTITION BY segmento) * 100, 1) AS cobertura_pct FROM stats)"""


@query(f"WITH {CLUSTERED},{_PROFILES} SELECT * FROM prof")
def segment_profiles(spark, sf) -> DataFrame:
    return segment.segment_profiles(clustered_customers(spark, sf))


@query(
    f"""WITH {CLUSTERED}, stats AS (
      SELECT CASE WHEN grouping(segmento) = 1 THEN 'ALL' ELSE segmento END AS segmento, cluster_id,
             count(*) AS n_amostras, round_even(avg(churn), 4) AS churn_rate, {_RISK} AS risk_level, {_MEANS}
      FROM clus GROUP BY GROUPING SETS ((segmento, cluster_id), (cluster_id)))
    SELECT *, round_even(n_amostras / sum(n_amostras) OVER (PARTITION BY segmento) * 100, 1) AS cobertura_pct FROM stats"""
)
def segment_profiles_with_all(spark, sf) -> DataFrame:
    return segment.segment_profiles(clustered_customers(spark, sf), with_all=True)


@query(f"WITH {CLUSTERED} SELECT churn AS label, cluster_id AS cluster, count(*) AS n FROM clus GROUP BY ALL")
def label_cluster_table(spark, sf) -> DataFrame:
    return cm.contingency(clustered_customers(spark, sf), "churn", "cluster_id")


@query(
    f"""WITH {CLUSTERED} SELECT cluster_id, count(*) AS n, CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS not_empty
    FROM clus GROUP BY cluster_id"""
)
def cluster_sizes(spark, sf) -> DataFrame:
    sizes = clustered_customers(spark, sf).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("not_empty", (F.col("n") > 0).cast("int")).orderBy("cluster_id")


# --- clustering metrics --------------------------------------------------------------

_SUMS = ", ".join(f"sum({z}) AS s_{z}" for z in Z)
_NORM = " + ".join(f"{z} * {z}" for z in Z)
_CROSS = " + ".join(f"{z} * s_{z}" for z in Z)
_SIL = f"""
mom AS (SELECT cluster_id AS c, count(*) AS n, sum({_NORM}) AS q, {_SUMS} FROM clus GROUP BY cluster_id),
pair AS (SELECT customer_id, cluster_id, c, n, greatest(({_NORM}) - 2 * ({_CROSS}) / n + q / n, 0) AS msd FROM clus, mom),
ab AS (SELECT customer_id, cluster_id, min(msd * n / nullif(n - 1, 0)) FILTER (c = cluster_id) AS a,
              min(msd) FILTER (c <> cluster_id) AS b FROM pair GROUP BY customer_id, cluster_id),
sil AS (SELECT customer_id, cluster_id, coalesce((b - a) / nullif(greatest(a, b), 0), 0) AS s FROM ab)"""


@query(f"WITH {CLUSTERED},{_SIL} SELECT customer_id, cluster_id, round(s, 6) AS silhouette_sq FROM sil")
def silhouette_samples(spark, sf) -> DataFrame:
    scored = cm.silhouette_samples(clustered_customers(spark, sf), Z)
    return _rounded(scored.select("customer_id", "cluster_id", "silhouette_sq"), "silhouette_sq")


@query(
    f"""WITH {CLUSTERED},{_SIL} SELECT customer_id, cluster_id, CAST(row_number() OVER (PARTITION BY cluster_id
    ORDER BY round(s, 6), customer_id) AS INTEGER) AS bar FROM sil"""
)
def silhouette_bar_positions(spark, sf) -> DataFrame:
    """Place of each row in its cluster by silhouette; the rank is summed over value
    ranges, since a cluster holds a large part of all rows."""
    scored = cm.silhouette_samples(clustered_customers(spark, sf), Z).select(
        "customer_id", "cluster_id", F.struct(F.round("silhouette_sq", 6).alias("s"), "customer_id").alias("pos")
    )
    ranked = prefix_sums(scored.withColumn("one", F.lit(1)), "pos", ["one"], ["cluster_id"])
    return ranked.select("customer_id", "cluster_id", F.col("cum_one").cast("int").alias("bar"))


_INTERNAL = f"""
centre AS (SELECT cluster_id AS c, count(*) AS n, {', '.join(f'avg({z}) AS c_{f}' for z, f in zip(Z, FEATURES_8))} FROM clus GROUP BY cluster_id),
grand AS (SELECT {', '.join(f'avg({z}) AS g_{f}' for z, f in zip(Z, FEATURES_8))} FROM clus),
own AS (SELECT cluster_id, {DIST_SQL} AS d2 FROM clus JOIN centre ON cluster_id = c),
spread AS (SELECT cluster_id, avg(sqrt(d2)) AS s, sum(d2) AS w FROM own GROUP BY cluster_id),
ratio AS (SELECT a.c, max((sa.s + sb.s) / sqrt({' + '.join(f'(a.c_{f} - b.c_{f}) * (a.c_{f} - b.c_{f})' for f in FEATURES_8)})) AS r
  FROM centre a JOIN centre b ON a.c <> b.c JOIN spread sa ON sa.cluster_id = a.c JOIN spread sb ON sb.cluster_id = b.c GROUP BY a.c),
bw AS (SELECT sum(n * ({' + '.join(f'(c_{f} - g_{f}) * (c_{f} - g_{f})' for f in FEATURES_8)})) AS b, count(*) AS k, sum(n) AS n FROM centre, grand),
internal AS (SELECT (SELECT avg(s) FROM sil) AS silhouette_sq, (SELECT avg(r) FROM ratio) AS davies_bouldin,
  (b / (k - 1)) / ((SELECT sum(w) FROM spread) / (n - k)) AS calinski_harabasz, (SELECT sum(w) FROM spread) AS inertia FROM bw)"""
_INTERNAL_COLS = "round(silhouette_sq, 6) AS silhouette_sq, round(davies_bouldin, 6) AS davies_bouldin, round(calinski_harabasz, 4) AS calinski_harabasz, round(inertia, 4) AS inertia"


@query(f"WITH {CLUSTERED},{_SIL},{_INTERNAL} SELECT {_INTERNAL_COLS} FROM internal")
def internal_cluster_metrics(spark, sf) -> DataFrame:
    m = cm.internal_metrics(clustered_customers(spark, sf), Z)
    return _rounded(_rounded(m, "silhouette_sq", "davies_bouldin"), "calinski_harabasz", "inertia", digits=4)


def external_sql(source: str, label: str, cluster: str) -> str:
    return f"""
cells AS (SELECT {label} AS y, {cluster} AS c, count(*)::DOUBLE AS m FROM {source} GROUP BY ALL),
ys AS (SELECT sum(m) AS m FROM cells GROUP BY y), cs AS (SELECT sum(m) AS m FROM cells GROUP BY c),
t AS (SELECT (SELECT sum(m * (m - 1) / 2) FROM cells) AS p0, (SELECT sum(m * (m - 1) / 2) FROM ys) AS p1,
  (SELECT sum(m * (m - 1) / 2) FROM cs) AS p2, (SELECT sum(m) FROM cells) AS n,
  (SELECT sum(m * ln(m)) FROM cells) AS l0, (SELECT sum(m * ln(m)) FROM ys) AS l1, (SELECT sum(m * ln(m)) FROM cs) AS l2),
e AS (SELECT *, p1 * p2 / (n * (n - 1) / 2) AS ex, ln(n) - l0 / n AS h0, ln(n) - l1 / n AS h1, ln(n) - l2 / n AS h2 FROM t),
ext AS (SELECT CASE WHEN (p1 + p2) / 2 - ex = 0 THEN 1 ELSE (p0 - ex) / ((p1 + p2) / 2 - ex) END AS adjusted_rand,
  CASE WHEN h1 <= 1e-12 THEN 1 ELSE (h1 + h2 - h0) / h1 END AS homogeneity,
  CASE WHEN h2 <= 1e-12 THEN 1 ELSE (h1 + h2 - h0) / h2 END AS completeness FROM e)
SELECT round(adjusted_rand, 6) AS adjusted_rand, round(homogeneity, 6) AS homogeneity, round(completeness, 6) AS completeness,
  round(coalesce(2 * homogeneity * completeness / nullif(homogeneity + completeness, 0), 0), 6) AS v_measure FROM ext"""


_EXT_NAMES = ("adjusted_rand", "homogeneity", "completeness", "v_measure")


@query(f"WITH {CLUSTERED},{external_sql('clus', 'churn', 'cluster_id')}")
def external_cluster_metrics(spark, sf) -> DataFrame:
    return _rounded(cm.external_metrics(clustered_customers(spark, sf), "churn", "cluster_id"), *_EXT_NAMES)


@query(
    """WITH parts AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
    means AS (SELECT label AS c, i, avg(x) AS x FROM parts GROUP BY ALL),
    gaps AS (SELECT vec_id, label, c, round(sum((p.x - q.x) * (p.x - q.x)), 9) AS d FROM parts p JOIN means q ON p.i = q.i GROUP BY ALL),
    lc AS (SELECT vec_id, label, arg_min(c, (d, c)) AS c FROM gaps GROUP BY ALL),"""
    + external_sql("lc", "label", "lc.c")
)
def embedding_label_agreement(spark, sf) -> DataFrame:
    """External metrics of the nearest label centroid, over all components, against the labels."""
    v = table(spark, sf, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("v"))
    cents = group_centroids(v, "label", "v", DIMS).collect()  # one row per label
    distance = [
        F.round(F.aggregate(F.zip_with("v", F.array(*map(F.lit, r["centroid"])), lambda x, c: (x - c) * (x - c)), F.lit(0.0), lambda s, x: s + x), 9)
        for r in cents
    ]
    best = F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(r["label"]).alias("c")) for d, r in zip(distance, cents)]))
    return _rounded(cm.external_metrics(v.select("label", best["c"].alias("c")), "label", "c"), *_EXT_NAMES)


_OTHER = "(SELECT c2.customer_id, min(d) AS b FROM (SELECT clus.customer_id, cid, sqrt(" + DIST_SQL + ") AS d FROM clus, cent WHERE cid <> clus.cluster_id) c2 GROUP BY c2.customer_id)"


@query(
    f"""WITH {CLUSTERED} SELECT clus.customer_id, clus.cluster_id, round((b - sqrt(sq_distance)) / greatest(b, sqrt(sq_distance)), 6) AS silhouette
    FROM clus JOIN {_OTHER} o ON o.customer_id = clus.customer_id"""
)
def silhouette_euclid(spark, sf) -> DataFrame:
    """Euclidean silhouette of every row by its distances to the own and the nearest other centroid."""
    scaled = scaled_customers(spark, sf)
    cents = fit_centroids(scaled, Z, "segmento")
    df = assign_nearest(scaled, Z, cents)
    return _rounded(cm.silhouette_centroids(df, Z, cents).select("customer_id", "cluster_id", "silhouette"), "silhouette")


_GAP = " + ".join(f"(x.{z} - y.{z}) * (x.{z} - y.{z})" for z in Z)


@query(
    f"""WITH {CLUSTERED}, size AS (SELECT cluster_id AS c, count(*) AS n FROM clus GROUP BY cluster_id),
    s AS (SELECT x.customer_id, x.cluster_id, y.cluster_id AS c, sum(sqrt({_GAP})) AS d FROM clus x, clus y GROUP BY ALL),
    m AS (SELECT customer_id, cluster_id, min(d / nullif(n - 1, 0)) FILTER (s.c = cluster_id) AS a, min(d / n) FILTER (s.c <> cluster_id) AS b
          FROM s JOIN size ON size.c = s.c GROUP BY customer_id, cluster_id)
    SELECT customer_id::BIGINT AS customer_id, cluster_id::BIGINT AS cluster_id,
      round(CASE WHEN a IS NULL THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END, 6) AS silhouette FROM m"""
)
def silhouette_pairwise(spark, sf) -> DataFrame:
    """Euclidean silhouette of every row over its distances to all others, summed between blocks of rows."""
    rows = materialize(clustered_customers(spark, sf).select("customer_id", "cluster_id", *Z), "silhouette-rows")
    return _rounded(silhouette.silhouette_pairwise(rows, Z, "customer_id"), "silhouette")


@query(f"WITH {CLUSTERED} SELECT round(sum(sq_distance), 4) AS inertia FROM clus")
def cluster_inertia(spark, sf) -> DataFrame:
    return _rounded(cm.inertia(clustered_customers(spark, sf)), "inertia", digits=4)


CLUSTER_GATES = (
    ("silhouette_sq", ">=", 0.3),
    ("davies_bouldin", "<", 1.5),
    ("calinski_harabasz", ">", 0.0),
    ("v_measure", ">=", 0.5),
    ("homogeneity", ">=", 0.0),
    ("homogeneity", "<=", 1.0),
    ("completeness", ">=", 0.0),
    ("completeness", "<=", 1.0),
    ("adjusted_rand", ">=", -1.0),
    ("adjusted_rand", "<=", 1.0),
)
_GATE_ROWS = ", ".join(f"('{m}', '{op}', {x}e0)" for m, op, x in CLUSTER_GATES)
CLUSTER_METRICS = ("silhouette_sq", "davies_bouldin", "calinski_harabasz", *_EXT_NAMES)
METRIC_ROWS = (
    f"{CLUSTERED},{_SIL},{_INTERNAL}, ex AS (WITH {external_sql('clus', 'churn', 'cluster_id')}), v AS ("
    "SELECT 'silhouette_sq' AS metric, round(silhouette_sq, 6) AS value FROM internal "
    "UNION ALL SELECT 'davies_bouldin', round(davies_bouldin, 6) FROM internal "
    "UNION ALL SELECT 'calinski_harabasz', round(calinski_harabasz, 4) FROM internal "
    + " ".join(f"UNION ALL SELECT '{m}', {m} FROM ex" for m in _EXT_NAMES)
    + ")"
)


def cluster_metric_rows(spark, sf) -> DataFrame:
    """(metric, value) of all internal and external metrics."""
    inside = metrics.metrics_long(internal_cluster_metrics(spark, sf), CLUSTER_METRICS[:3])
    return inside.unionByName(metrics.metrics_long(external_cluster_metrics(spark, sf), _EXT_NAMES))


@query(
    f"""WITH {METRIC_ROWS}, g AS (SELECT * FROM (VALUES {_GATE_ROWS}) t(metric, op, gate))
    SELECT v.metric, value, op, gate, CASE WHEN (op = '>=' AND value >= gate) OR (op = '>' AND value > gate)
      OR (op = '<' AND value < gate) OR (op = '<=' AND value <= gate) THEN 1 ELSE 0 END AS pass FROM v JOIN g ON v.metric = g.metric"""
)
def cluster_gates(spark, sf) -> DataFrame:
    return metrics.apply_gates(cluster_metric_rows(spark, sf), CLUSTER_GATES)


_K_CENTROIDS = (2, 3, 4, 5)


@query(
    f"""WITH {SCALED}, bands AS (SELECT *, num_products - 1 AS band FROM scaled WHERE num_products BETWEEN 1 AND 5),
    cent AS (SELECT band, {', '.join(f'avg(z_{f}) AS c_{f}' for f in FEATURES_8)} FROM bands GROUP BY band),
    d AS (SELECT k, customer_id, min({DIST_SQL}) AS d2 FROM scaled, cent, (SELECT unnest([2, 3, 4, 5]) AS k)
          WHERE band >= 5 - k GROUP BY k, customer_id),
    i AS (SELECT CAST(k AS INTEGER) AS k, round(sum(d2), 4) AS inertia FROM d GROUP BY k)
    SELECT k, inertia, CASE WHEN lag(inertia) OVER (ORDER BY k) IS NULL OR inertia < lag(inertia) OVER (ORDER BY k)
      THEN 1 ELSE 0 END AS decreases FROM i"""
)
def inertia_by_k(spark, sf) -> DataFrame:
    """Inertia for nested sets of given centroids (means per number of products)."""
    df = scaled_customers(spark, sf).select("customer_id", "num_products", *Z)
    rows = (
        df.filter(F.col("num_products").between(1, 5))
        .groupBy("num_products")
        .agg(*[F.avg(z).alias(z) for z in Z])
        .collect()
    )
    cents = {r["num_products"] - 1: [r[z] for z in Z] for r in rows}
    nearest = {
        k: F.array_min(F.array(*[cm.squared_distance(Z, c) for b, c in cents.items() if b >= 5 - k]))
        for k in _K_CENTROIDS
    }
    wide = df.agg(*[F.round(F.sum(d), 4).alias(str(k)) for k, d in nearest.items()])
    long = wide.unpivot([], [str(k) for k in _K_CENTROIDS], "k", "inertia")
    return cm.strictly_decreasing(long.withColumn("k", F.col("k").cast("int")), "k", "inertia")


@query(
    f"WITH {CLUSTERED} "
    + " UNION ALL ".join(
        f"SELECT cluster_id, '{f}' AS feature, round(CAST(sum(CAST({f} AS DECIMAL(28,6))) AS DOUBLE) / count(*), 6) AS mean,"
        f" round(stddev_pop({f}), 6) AS std FROM clus GROUP BY cluster_id"
        for f in FEATURES_8
    )
)
def card_means_and_deviations(spark, sf) -> DataFrame:
    return _rounded(segment.mean_and_std(clustered_customers(spark, sf), FEATURES_8, "cluster_id"), "mean", "std")


@query(
    f"""WITH {CLUSTERED} SELECT cluster_id, num_products, count(*) AS n,
    count(*) / sum(count(*)) OVER (PARTITION BY cluster_id) * 100 AS pct FROM clus GROUP BY cluster_id, num_products"""
)
def product_frequency(spark, sf) -> DataFrame:
    return segment.category_share(clustered_customers(spark, sf), "cluster_id", "num_products")


@query(
    f"""WITH {CLUSTERED}, r AS (SELECT customer_id, cluster_id, round(sq_distance, 6) AS d FROM clus),
    lim AS (SELECT cluster_id, quantile_disc(d, 0.95) AS q FROM r GROUP BY cluster_id)
    SELECT customer_id, r.cluster_id, CASE WHEN d > q THEN 1 ELSE 0 END AS out_of_profile FROM r JOIN lim ON r.cluster_id = lim.cluster_id"""
)
def out_of_profile(spark, sf) -> DataFrame:
    rounded = _rounded(clustered_customers(spark, sf), "sq_distance")
    return cm.out_of_profile(rounded).select("customer_id", "cluster_id", "out_of_profile")


@query(
    f"WITH {CLUSTERED}, r AS (SELECT cluster_id, round(sq_distance, 6) AS d FROM clus) "
    "SELECT cluster_id, quantile_disc(d, 0.5) AS q0, quantile_disc(d, 0.9) AS q1 FROM r GROUP BY cluster_id"
)
def distance_quantiles(spark, sf) -> DataFrame:
    rounded = _rounded(clustered_customers(spark, sf).select("cluster_id", "sq_distance"), "sq_distance")
    return exact_quantiles(rounded, "sq_distance", [0.5, 0.9], ["cluster_id"])


# --- cards ---------------------------------------------------------------------------


def _fixed(col: str, d: int) -> str:
    return f"printf('%.{d}f', round(mean_{col}, {d}))"


def _sentence_sql(risk: str) -> str:
    template, slots = segment.CARD_TEXT[risk]
    pieces = template.split("%s")
    values = ["segmento"] + [_fixed(f, d) for f, d in slots]
    out = []
    for i, piece in enumerate(pieces):
        if piece:
            out.append("'" + piece + "'")
        if i < len(values):
            out.append(values[i])
    return "concat(" + ", ".join(out) + ")"


LOW, HIGH = segment.RISK_LOW, segment.RISK_HIGH


def _pick(low: str, high: str) -> str:
    return f"CASE WHEN risk_level = '{LOW}' THEN {low} ELSE {high} END"


CARDS = (
    CLUSTERED
    + ","
    + _PROFILES
    + f""",
cards AS (
  SELECT cluster_id, segmento, concat(segmento, ' ', {_pick(f"'{segment.LABEL_SUFFIX[LOW]}'", f"'{segment.LABEL_SUFFIX[HIGH]}'")}) AS perfil_label,
    risk_level, churn_rate, cobertura_pct, n_amostras,
    {_pick(_sentence_sql(LOW), _sentence_sql(HIGH))} AS description,
    {_pick(f"'{segment.CARD_ACTION[LOW]}'", f"'{segment.CARD_ACTION[HIGH]}'")} AS action_recommendation,
    {_pick(f"'{segment.NO_BOTTLENECK}'", f"concat_ws('|', CASE WHEN mean_payment_delay_days > 5 THEN concat('BU_WAIT_DAYS > ', {_fixed('payment_delay_days', 0)}, 'd') END, CASE WHEN mean_support_calls > 5 THEN 'ACCESS_SLA_DAYS alto' END)")} AS gargalos,
    concat_ws(' ', lower(segmento), replace(lower(risk_level), ' ', '_'), concat('cluster_', cluster_id),
      CASE WHEN mean_satisfaction_score >= 7 THEN 'alta_satisfacao' ELSE 'baixa_satisfacao' END,
      CASE WHEN mean_tenure_months >= 24 THEN 'longa_permanencia' ELSE 'cliente_novo' END) AS rag_tags,
    {', '.join(f'mean_{f}' for f in FEATURES_8)}
  FROM prof),
texts AS (
  SELECT *, concat_ws(' ', perfil_label, concat('segmento ', segmento), concat('risco ', risk_level), description,
    action_recommendation, rag_tags, concat('tenure ', {_fixed('tenure_months', 0)}, ' meses'),
    concat('cobranca mensal ', {_fixed('monthly_charges', 0)}), concat('chamados suporte ', {_fixed('support_calls', 0)}),
    concat('atraso pagamento ', {_fixed('payment_delay_days', 0)}, ' dias'), concat('satisfacao ', {_fixed('satisfaction_score', 1)}),
    concat('churn rate ', printf('%.2f', round(churn_rate, 2)))) AS text
  FROM cards)"""
)
_CARD_COLS = "cluster_id, segmento, perfil_label, risk_level, churn_rate, cobertura_pct, n_amostras, description, action_recommendation, gargalos, rag_tags"


def cards(spark, sf) -> DataFrame:
    return segment.profile_cards(segment.segment_profiles(clustered_customers(spark, sf)))


def _cards_of(clustered: DataFrame) -> DataFrame:
    """Cards written once: one row per segment and cluster."""
    return materialize(segment.profile_cards(segment.segment_profiles(clustered)), "cards")


@query(f"WITH {CARDS} SELECT {_CARD_COLS}, {', '.join(f'mean_{f}' for f in FEATURES_8)} FROM cards")
def profile_cards(spark, sf) -> DataFrame:
    flat = cards(spark, sf).withColumns(
        {"gargalos": F.array_join("gargalos", "|"), "rag_tags": F.array_join("rag_tags", " ")}
    )
    means = {f"mean_{f}": F.col("feature_means")[f] for f in FEATURES_8}
    return flat.withColumns(means).drop("feature_means")


@query(f"WITH {CARDS} SELECT segmento, cluster_id, text FROM texts")
def card_texts(spark, sf) -> DataFrame:
    return segment.card_text(cards(spark, sf)).select("segmento", "cluster_id", "text")


@query(f"WITH {CARDS} SELECT {_CARD_COLS} FROM cards")
def nested_card_scan(spark, sf) -> DataFrame:
    """Cards nested to JSON text and scanned back into flat rows."""
    nested = nest_cards(cards(spark, sf))
    flat = explode_cards(nested.select(parse_cards(F.col("value")).alias("cards")))
    return flat.drop("cluster_key", "feature_means").withColumns(
        {"gargalos": F.array_join("gargalos", "|"), "rag_tags": F.array_join("rag_tags", " ")}
    )


@query(f"WITH {CARDS} SELECT segmento, cluster_id, perfil_label FROM cards WHERE segmento = 'PF'")
def list_segment_profiles(spark, sf) -> DataFrame:
    return cards(spark, sf).filter("segmento = 'PF'").select("segmento", "cluster_id", "perfil_label")


def scored_with_cards(spark, sf) -> DataFrame:
    """Clustered, scored customers with their card label."""
    clustered = clustered_customers(spark, sf)
    known = _cards_of(clustered)
    return score.lookup_cards(clustered.withColumn("score", raw_score()), known)


_BAND = "CASE WHEN p < 0.30 THEN 'BAIXO' WHEN p < 0.60 THEN 'MÉDIO' ELSE 'ALTO' END"


@query(
    f"""WITH {CARDS}, sc AS (SELECT clus.*, {RAW_SCORE} AS p FROM clus)
    SELECT customer_id, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS churn_prediction, round_even(p, 4) AS churn_probability,
      {_BAND} AS risk_level, 'unknown' AS model_version, sc.cluster_id, cards.perfil_label, sc.segmento
    FROM sc LEFT JOIN cards ON sc.segmento = cards.segmento AND sc.cluster_id = cards.cluster_id"""
)
def prediction_responses(spark, sf) -> DataFrame:
    return score.respond(scored_with_cards(spark, sf), "score")


@query(
    f"""WITH {SCORED}, b AS (SELECT score AS p FROM scored)
    SELECT {_BAND} AS risk_level, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS churn_prediction, count(*) AS n FROM b GROUP BY ALL"""
)
def risk_bands(spark, sf) -> DataFrame:
    p = F.col("score")
    return scored_customers(spark, sf).groupBy(
        score.risk_band(p).alias("risk_level"), score.decide(p).alias("churn_prediction")
    ).agg(F.count(F.lit(1)).alias("n"))
