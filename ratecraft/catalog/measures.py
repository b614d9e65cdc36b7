"""Section 2.11: evaluation metrics over the predictions of the bias baseline."""

from pyspark.sql import functions as F

from ratecraft import ITEM, PAIR, PREDICTION, RATING
from ratecraft.catalog.columns import rounded
from ratecraft.catalog.oracle_views import VIEWS
from ratecraft.catalog.registry import query
from ratecraft.metrics import accuracy, coverage, diversity, report, serendipity, toplist
from ratecraft.metrics.novelty import item_probability, novelty
from ratecraft.models.bias import BiasModel
from ratecraft.operators import relational as rel
from ratecraft.operators.ranking import top_n
from ratecraft.operators.splits import cohorts

# Each measure as a one-row view, so that the reports below are put together from the same texts.
VIEWS["m_rmse"] = ("predictions corpus", """
    SELECT sqrt(avg(pow(p.prediction - a.rating, 2))) AS rmse
    FROM predictions p JOIN corpus a ON a.user_id = p.user_id AND a.business_id = p.business_id""")
VIEWS["m_mae"] = ("predictions interactions", """
    SELECT avg(abs(p.prediction - a.rating)) AS mae
    FROM predictions p JOIN interactions a ON a.user_id = p.user_id AND a.business_id = p.business_id""")
VIEWS["serendipity_rows"] = ("predictions test item_prob", """
    SELECT user_id, greatest(CASE WHEN found = 1 THEN 1 ELSE (found - rank) / CAST(nullif(found - 1, 0) AS DOUBLE) END
                             - prob, 0) AS gain
    FROM (SELECT p.user_id, p.business_id,
                 row_number() OVER (PARTITION BY p.user_id ORDER BY round(p.prediction, 6) DESC, p.business_id) AS rank,
                 count(*) OVER (PARTITION BY p.user_id) AS found
          FROM predictions p JOIN test t ON t.user_id = p.user_id AND t.business_id = p.business_id
          WHERE t.rating >= 1) r JOIN item_prob i ON i.business_id = r.business_id""")
VIEWS["m_serendipity"] = ("serendipity_rows", """
    SELECT (SELECT avg(gain) FROM serendipity_rows) AS avg_overall_serendipity,
           (SELECT avg(m) FROM (SELECT avg(gain) AS m FROM serendipity_rows GROUP BY user_id)) AS avg_serendipity""")
_NOVELTY = """
    SELECT (SELECT avg(nov) FROM {0}) AS avg_overall_novelty,
           (SELECT avg(m) FROM (SELECT avg(nov) AS m FROM {0} GROUP BY user_id)) AS avg_novelty"""
_NOVELTY_ROWS = """
    SELECT p.user_id, log2(greatest(i.prob, 1e-100)) AS nov
    FROM {0} p JOIN item_prob i ON i.business_id = p.business_id"""
VIEWS["novelty_rows"] = ("predictions item_prob", _NOVELTY_ROWS.format("predictions"))
VIEWS["m_novelty"] = ("novelty_rows", _NOVELTY.format("novelty_rows"))
VIEWS["novelty_rows10"] = ("top10 item_prob", _NOVELTY_ROWS.format("top10"))
VIEWS["m_novelty10"] = ("novelty_rows10", _NOVELTY.format("novelty_rows10"))
VIEWS["m_share"] = ("predictions corpus", """
    SELECT (SELECT count(DISTINCT business_id) FROM predictions WHERE prediction >= 1)
           / CAST((SELECT count(DISTINCT business_id) FROM corpus) AS DOUBLE) AS coverage""")
VIEWS["m_precision10"] = ("top10 test", """
    SELECT (SELECT count(*) FROM top10 p JOIN test t ON t.user_id = p.user_id AND t.business_id = p.business_id)
           / CAST((SELECT count(DISTINCT user_id) FROM test) * 10 AS DOUBLE) AS precision_at_n""")
_DIVERSITY = """
    SELECT (SELECT avg(list_sum(c.features)) FROM top10 p JOIN {0} c ON c.business_id = p.business_id)
           * (SELECT avg(list_sum(features)) FROM {0}) / (SELECT max(len(features)) FROM {0}) AS cat_diversity"""
VIEWS["m_diversity"] = ("top10 item_categories", _DIVERSITY.format("item_categories"))
VIEWS["m_diversity_content"] = ("top10 item_content", _DIVERSITY.format("item_content"))
VIEWS["list_pairs"] = ("top10 item_content", """
    SELECT a.user_id, list_cosine_distance(x.features, y.features) AS dist
    FROM top10 a JOIN top10 b ON a.user_id = b.user_id AND a.business_id < b.business_id
    JOIN item_content x ON x.business_id = a.business_id JOIN item_content y ON y.business_id = b.business_id""")
VIEWS["m_ils"] = ("list_pairs top10 item_content", """
    SELECT sum(d) / CAST((SELECT count(DISTINCT p.user_id) FROM top10 p JOIN item_content c
                          ON c.business_id = p.business_id) AS DOUBLE) AS ils_distance
    FROM (SELECT user_id, avg(dist) AS d FROM list_pairs GROUP BY user_id)""")
VIEWS["m_catalog"] = ("predictions corpus", """
    SELECT 100.0::DOUBLE * (SELECT count(*) FROM predictions)
           / ((SELECT count(DISTINCT user_id) FROM corpus) * (SELECT count(DISTINCT business_id) FROM corpus))
           AS catalog_coverage""")
VIEWS["m_items"] = ("predictions corpus item_content", """
    SELECT 100.0::DOUBLE * (SELECT count(DISTINCT business_id) FROM predictions)
           / (SELECT count(*) FROM (SELECT business_id FROM corpus UNION SELECT business_id FROM item_content))
           AS item_coverage""")
VIEWS["m_users"] = ("predictions corpus", """
    SELECT 100.0::DOUBLE * (SELECT count(DISTINCT user_id) FROM predictions)
           / (SELECT count(DISTINCT user_id) FROM corpus) AS user_coverage""")
VIEWS["m_predicted"] = ("predictions test", """
    SELECT 100.0::DOUBLE * (SELECT count(*) FROM predictions p JOIN test t
                    ON t.user_id = p.user_id AND t.business_id = p.business_id) / (SELECT count(*) FROM test)
           AS prediction_coverage""")
VIEWS["nearest"] = ("train top10 item_content", """
    SELECT t.user_id, t.business_id, min(list_cosine_distance(x.features, y.features)) AS min_dist
    FROM train a JOIN top10 t ON a.user_id = t.user_id
    JOIN item_content x ON x.business_id = a.business_id JOIN item_content y ON y.business_id = t.business_id
    GROUP BY t.user_id, t.business_id""")
VIEWS["m_content"] = ("nearest", """
    SELECT (SELECT avg(min_dist) FROM nearest) AS avg_overall_content_serendipity,
           (SELECT avg(m) FROM (SELECT avg(min_dist) AS m FROM nearest GROUP BY user_id)) AS avg_content_serendipity""")
VIEWS["m_ranks"] = ("ranked test", """
    SELECT avg(lo) AS mean_min_rank, avg(mid) AS mean_avg_rank, avg(hi) AS mean_max_rank
    FROM (SELECT min(k.rank) AS lo, avg(k.rank) AS mid, max(k.rank) AS hi FROM ranked k
          JOIN test t ON t.user_id = k.user_id AND t.business_id = k.business_id GROUP BY k.user_id)""")
VIEWS["m_rmse10"] = ("top10 test", """
    SELECT sqrt(avg(pow(p.prediction - a.rating, 2))) AS rmse
    FROM top10 p JOIN test a ON a.user_id = p.user_id AND a.business_id = p.business_id""")
VIEWS["m_mae10"] = ("top10 test", """
    SELECT avg(abs(p.prediction - a.rating)) AS mae
    FROM top10 p JOIN test a ON a.user_id = p.user_id AND a.business_id = p.business_id""")


def shown(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def one_row(view: str, *columns: str) -> dict:
    return {"uses": view, "sql": f"SELECT {shown(*columns)} FROM {view}"}


def _prob(v):
    return item_probability(rel.corpus(v.train, v.test))


@query("met_01_rmse", **one_row("m_rmse", "rmse"))
def rmse(v):
    return rounded(accuracy.rmse(v.train, v.test, v.predictions), "rmse")


@query("met_02_rmse_aligned", uses="predictions", sql="""
    SELECT round(sqrt(avg(pow(prediction - rating, 2))), 6) AS rmse, round(avg(pow(prediction - rating, 2)), 6) AS mse
    FROM predictions""")
def rmse_aligned(v):
    return rounded(accuracy.aligned_errors(v.predictions), "rmse", "mse")


@query("met_03_mae", **one_row("m_mae", "mae"))
def mae(v):
    return rounded(accuracy.mae(v.interactions, v.predictions), "mae")


_CLASSES = """
    WITH j AS (SELECT CAST(round_even(p.prediction, 0) AS INTEGER) AS p, CAST(round_even(a.rating, 0) AS INTEGER) AS a
               FROM predictions p JOIN interactions a ON a.user_id = p.user_id AND a.business_id = p.business_id),
         labels AS (SELECT p AS label FROM j UNION SELECT a FROM j),
         s AS (SELECT label, (SELECT count(*) FROM j WHERE p = label) AS predicted,
                      (SELECT count(*) FROM j WHERE a = label) AS support,
                      (SELECT count(*) FROM j WHERE a = label AND p = label) AS hits FROM labels),
         scores AS (SELECT label, coalesce(hits / CAST(nullif(predicted, 0) AS DOUBLE), 0) AS precision,
                      coalesce(hits / CAST(nullif(support, 0) AS DOUBLE), 0) AS recall,
                      coalesce(2 * hits / CAST(nullif(predicted + support, 0) AS DOUBLE), 0) AS fscore, support FROM s)
"""


@query("met_04_class_scores", _CLASSES + f"SELECT label, {shown('precision', 'recall', 'fscore')}, support FROM scores",
       "predictions interactions")
def class_scores(v):
    return rounded(accuracy.class_scores(v.interactions, v.predictions), "precision", "recall", "fscore")


@query("met_04_macro_scores", _CLASSES + """
    SELECT round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(fscore), 6) AS fscore
    FROM scores""", "predictions interactions")
def macro_scores(v):
    return rounded(accuracy.macro_scores(accuracy.class_scores(v.interactions, v.predictions)),
                   "precision", "recall", "fscore")


@query("met_04_weighted_scores", _CLASSES + """
    SELECT round(sum(precision * support) / sum(support), 6) AS precision, round(sum(recall * support) / sum(support), 6) AS recall,
           round(sum(fscore * support) / sum(support), 6) AS fscore FROM scores""", "predictions interactions")
def weighted_scores(v):
    return rounded(accuracy.weighted_scores(accuracy.class_scores(v.interactions, v.predictions)), *accuracy.SCORES)


@query("met_04_micro_scores", _CLASSES + """
    , share AS (SELECT round(sum(hits) / CAST(sum(support) AS DOUBLE), 6) AS x FROM s)
    SELECT x AS precision, x AS recall, x AS fscore FROM share""", "predictions interactions")
def micro_scores(v):
    return rounded(accuracy.micro_scores(accuracy.class_scores(v.interactions, v.predictions)), *accuracy.SCORES)


@query("met_05_precision_at_n", **one_row("m_precision10", "precision_at_n"))
def precision_at_n(v):
    return rounded(accuracy.precision_at_n(v.test, v.predictions, 10), "precision_at_n")


@query("met_06_category_diversity", **one_row("m_diversity", "cat_diversity"))
def category_diversity(v):
    return rounded(diversity.category_diversity(top_n(v.predictions), v.item_categories), "cat_diversity")


@query("met_07_list_distance", **one_row("m_ils", "ils_distance"))
def list_distance(v):
    return rounded(diversity.intra_list_distance(top_n(v.predictions), v.item_content), "ils_distance")


@query("met_08_catalog_coverage", **one_row("m_catalog", "catalog_coverage"))
def catalog_coverage(v):
    return rounded(coverage.catalog_coverage(v.test, v.train, v.predictions), "catalog_coverage")


@query("met_09_item_coverage", **one_row("m_items", "item_coverage"))
def item_coverage(v):
    return rounded(coverage.item_coverage(v.test, v.train, v.item_content, v.predictions), "item_coverage")


@query("met_10_user_coverage", **one_row("m_users", "user_coverage"))
def user_coverage(v):
    return rounded(coverage.user_coverage(v.test, v.train, v.predictions), "user_coverage")


@query("met_11_prediction_coverage", **one_row("m_predicted", "prediction_coverage"))
def prediction_coverage(v):
    return rounded(coverage.prediction_coverage(v.test, v.predictions), "prediction_coverage")


@query("met_12_serendipity", **one_row("m_serendipity", "avg_overall_serendipity", "avg_serendipity"))
def serendipity_by_rank(v):
    return rounded(serendipity.serendipity(v.test, v.predictions, _prob(v)), "avg_overall_serendipity",
                   "avg_serendipity")


@query("met_13_novelty", **one_row("m_novelty10", "avg_overall_novelty", "avg_novelty"))
def novelty_of_lists(v):
    return rounded(novelty(top_n(v.predictions), _prob(v)), "avg_overall_novelty", "avg_novelty")


@query("met_14_content_serendipity",
       **one_row("m_content", "avg_overall_content_serendipity", "avg_content_serendipity"))
def content_serendipity(v):
    return rounded(serendipity.content_serendipity(v.train, top_n(v.predictions), v.item_content),
                   "avg_overall_content_serendipity", "avg_content_serendipity")


@query("met_15_relevant_ranks", **one_row("m_ranks", "mean_min_rank", "mean_avg_rank", "mean_max_rank"))
def relevant_ranks(v):
    return rounded(accuracy.relevant_rank_stats(v.test, v.predictions), "mean_min_rank", "mean_avg_rank",
                   "mean_max_rank")


@query("met_16_catalogue_share", **one_row("m_share", "coverage"))
def catalogue_share(v):
    total = rel.corpus(v.train, v.test).agg(F.count_distinct(ITEM)).scalar()
    return rounded(coverage.catalogue_share(v.predictions, 1.0, total), "coverage")


def item_offsets(v):
    """Item order of the bias baseline: its item offsets, the same order for every user."""
    def build():
        fitted = BiasModel().fit(v.train)
        return fitted.items.withColumnRenamed("b_i", "score")
    return v.stored("item_offsets", build)


VIEWS["candidates"] = ("train test bias_i", """
    SELECT u.user_id, i.business_id, round(i.b_i, 6) AS score,
           CASE WHEN t.user_id IS NULL THEN 0 ELSE 1 END AS hit
    FROM (SELECT DISTINCT user_id FROM test) u CROSS JOIN bias_i i
    LEFT JOIN test t ON t.user_id = u.user_id AND t.business_id = i.business_id
    WHERE NOT EXISTS (SELECT 1 FROM train r WHERE r.user_id = u.user_id AND r.business_id = i.business_id)""")


@query("met_18_auc", uses="candidates", sql="""
    WITH r AS (SELECT user_id, hit, rank() OVER (PARTITION BY user_id ORDER BY score)
                      + (count(*) OVER (PARTITION BY user_id, score) - 1) / 2.0::DOUBLE AS mid FROM candidates),
         s AS (SELECT user_id, sum(CASE WHEN hit = 1 THEN mid END) AS total, sum(hit) AS n_pos, count(*) - sum(hit) AS n_neg
               FROM r GROUP BY user_id)
    SELECT user_id, round(coalesce((total - n_pos * (n_pos + 1) / 2.0::DOUBLE)
                                   / CAST(nullif(n_pos * n_neg, 0) AS DOUBLE), 0.5), 6) AS auc
    FROM s WHERE n_pos > 0""")
def auc(v):
    return rounded(toplist.auc_by_item_score(item_offsets(v), v.test, v.train), "auc")


@query("met_19_precision_at_k", uses="candidates", sql="""
    WITH r AS (SELECT user_id, hit, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, business_id) AS rank
               FROM candidates)
    SELECT user_id, round(sum(CASE WHEN rank <= 20 THEN hit ELSE 0 END) / 20.0::DOUBLE, 6) AS precision
    FROM r GROUP BY user_id HAVING sum(hit) > 0""")
def precision_at_k(v):
    return rounded(toplist.precision_by_item_score(item_offsets(v), v.test, 20, v.train), "precision")


_STANDARD = "m_novelty m_serendipity m_rmse m_share"


def standard_sql(label: str) -> str:
    return f"SELECT '{label}' AS model, {shown(*report.STANDARD)} FROM m_novelty, m_serendipity, m_rmse, m_share"


@query("met_20_standard_report", standard_sql("bias"), _STANDARD)
def standard_report(v):
    return rounded(report.standard_report(v.train, v.test, v.predictions, "bias"), *report.STANDARD)


# The full report looks at the cut lists throughout.
for _name in ("m_catalog", "m_items", "m_users", "m_predicted", "serendipity_rows"):
    _uses, _body = VIEWS[_name]
    VIEWS[f"{_name}10"] = (_uses.replace("predictions", "top10"), _body.replace("FROM predictions", "FROM top10"))
VIEWS["m_serendipity10"] = ("serendipity_rows10", VIEWS["m_serendipity"][1].replace("serendipity_rows", "serendipity_rows10"))
VIEWS["nearest10"] = ("test top10 item_content", VIEWS["nearest"][1].replace("FROM train a", "FROM test a"))
VIEWS["m_content10"] = ("nearest10", VIEWS["m_content"][1].replace("nearest", "nearest10"))
VIEWS["ranked10"] = ("ranked", "SELECT * FROM ranked WHERE rank <= 10")
VIEWS["m_ranks10"] = ("ranked10 test", VIEWS["m_ranks"][1].replace("FROM ranked k", "FROM ranked10 k"))
_FULL = ("m_rmse10 m_mae10 m_precision10 m_diversity_content m_ils m_catalog10 m_items10 m_users10 m_predicted10 m_serendipity10 "
         "m_novelty10 m_content10 m_ranks10")


@query("met_21_full_report", f"SELECT 'bias' AS model, {shown(*report.FULL)} FROM {', '.join(_FULL.split())}", _FULL)
def full_report(v):
    return rounded(report.full_report(v.train, v.test, v.predictions, v.item_content, "bias", 10), *report.FULL)


@query("met_22_cohort_report", uses="cohort_rows predictions", sql="""
    SELECT c.cohort, round(avg(pow(p.prediction - p.rating, 2)), 6) AS mse, count(*) AS number_of_data_points
    FROM cohort_rows c JOIN predictions p ON p.user_id = c.user_id AND p.business_id = c.business_id GROUP BY c.cohort""")
def cohort_report(v):
    tagged = cohorts(v.train, v.test).drop("rating").join(v.predictions, PAIR)
    return rounded(report.cohort_errors(tagged), "mse")


VIEWS["item_mean_scored"] = ("test train", """
    SELECT t.user_id, t.business_id, t.rating, coalesce(m.mean, 3) AS prediction FROM test t
    LEFT JOIN (SELECT business_id, avg(rating) AS mean FROM train GROUP BY business_id) m
      ON m.business_id = t.business_id""")


@query("met_23_model_table", uses="predictions item_mean_scored", sql="""
    SELECT 'bias' AS model, round(sqrt(avg(pow(prediction - rating, 2))), 6) AS rmse, count(*) AS n FROM predictions
    UNION ALL
    SELECT 'item mean', round(sqrt(avg(pow(prediction - rating, 2))), 6), count(*) FROM item_mean_scored""")
def model_table(v):
    means = v.train.groupBy(ITEM).agg(F.avg(RATING).alias(PREDICTION))
    scored = v.test.join(means, ITEM, "left").fillna({PREDICTION: 3.0})
    rows = [accuracy.aligned_errors(p).select(F.lit(name).alias("model"), "rmse",
                                              p.agg(F.count(F.lit(1))).scalar().alias("n"))
            for name, p in (("bias", v.predictions), ("item mean", scored))]
    return rounded(report.compare_models(rows), "rmse")


