"""Section 2.10: rating models; 2.9: sweeps; 2.12: end-to-end jobs; content scores and lists."""

from pyspark.sql import functions as F

from ratecraft import ITEM, PAIR, PREDICTION, RATING, USER
from ratecraft.catalog.columns import rounded, wide
from ratecraft.catalog.measures import shown, standard_sql
from ratecraft.catalog import factor_views
from ratecraft.catalog.oracle_views import VIEWS, tfidf_views
from ratecraft.catalog.registry import query
from ratecraft.metrics import coverage, report
from ratecraft.models.als import AlsModel
from ratecraft.models.bias import BiasModel
from ratecraft.models.content import ContentModel
from ratecraft.models.factor import LogisticModel, SvdppModel
from ratecraft.models.neural import NeuralModel
from ratecraft.operators import ranking, relational as rel
from ratecraft.plans import discount, jobs, tuning

_HASH = "md5(concat(CAST(user_id AS VARCHAR), ':', CAST(business_id AS VARCHAR)))"

for _key, _name in (("user_id", "user_terms"), ("business_id", "item_terms")):
    VIEWS[_name] = ("tfidf words", f"""
        SELECT t.{_key}, t.term, sum(t.weight) / max(d.docs) AS weight FROM tfidf t
        JOIN (SELECT {_key}, count(*) AS docs FROM words GROUP BY {_key}) d ON d.{_key} = t.{_key}
        GROUP BY t.{_key}, t.term""")
VIEWS["content_full"] = ("user_terms item_terms", """
    SELECT u.user_id, i.business_id, sum(u.weight * i.weight) AS prediction
    FROM user_terms u JOIN item_terms i ON i.term = u.term GROUP BY u.user_id, i.business_id""")
VIEWS["content_scored"] = ("reviews content_full", """
    SELECT r.user_id, r.business_id, r.rating, coalesce(c.prediction, 0) AS prediction
    FROM reviews r LEFT JOIN content_full c ON c.user_id = r.user_id AND c.business_id = r.business_id""")


def content_vectors(v):
    """Mean vectors of users and items, written once for the queries that score with them."""
    return v.kept("content_vectors", lambda: ContentModel().fit(v.reviews))


@query("agg_15_mean_vectors", uses="user_terms item_terms", sql="""
    SELECT 'user' AS side, user_id AS id, term, round(weight, 6) AS weight FROM user_terms
    UNION ALL SELECT 'item', business_id, term, round(weight, 6) FROM item_terms""")
def mean_term_vectors(v):
    fitted = ContentModel(ids=False).fit(v.reviews)
    sides = [vectors.select(F.lit(side).alias("side"), F.col(key).alias("id"), "term",
                                                         F.round("weight", 6).alias("weight"))
             for side, key, vectors in (("user", USER, fitted.users), ("item", ITEM, fitted.items))]
    return sides[0].unionByName(sides[1])


@query("jn_10_full_scores", uses="content_full", sql="""
    SELECT user_id, business_id, round(prediction, 6) AS prediction FROM content_full""")
def full_scores(v):
    return rounded(content_vectors(v).full_scores(), PREDICTION)


@query("ord_03_content_top_n", uses="content_full", sql="""
    SELECT user_id, business_id, round(prediction, 6) AS prediction, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(prediction, 6) DESC, business_id) AS rank
      FROM content_full) WHERE rank <= 3""")
def content_top_n(v):
    return rounded(content_vectors(v).top_lists(3), PREDICTION)


@query("ord_03_bounded_top_n", uses="content_full", sql="""
    SELECT user_id, business_id, round(prediction, 6) AS prediction, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(prediction, 6) DESC, business_id) AS rank
      FROM content_full) WHERE rank <= 10""")
def bounded_top_n(v):
    return rounded(content_vectors(v).bounded_lists(10), PREDICTION)


@query("mod_01_bias", uses="predictions", sql="""
    SELECT user_id, business_id, rating, round(prediction, 6) AS prediction FROM predictions""")
def bias(v):
    return rounded(BiasModel().fit(v.train).predict(rel.triples(v.test)), PREDICTION)


# Trained once and stored: the queries that return the values, and those that compare what is certain of them (``certain``).


def als_scores(v):
    return v.stored("als_scores", lambda: AlsModel().fit(v.train).predict(rel.triples(v.test)))


def als_lists_of(v):
    return v.stored("als_lists", lambda: AlsModel().fit(v.train).recommend(10))


def neural_scores(v):
    rows = lambda part: rel.business_view(rel.with_business(part, v.business))
    return v.stored("neural_scores", lambda: NeuralModel(epochs=1).fit(rows(v.train)).predict(rows(v.test)).select(*PAIR, RATING, PREDICTION))


def als_grid(v):
    return v.stored("als_grid", lambda: tuning.sweep_als(v.train, v.test))


def neural_grid(v):
    return v.stored("neural_grid", lambda: tuning.sweep_neural(rel.business_view(rel.with_business(v.ratings, v.business))))


def als_row(v):
    return v.stored("als_row", lambda: jobs.als_job(v.ratings).report("als"))


def neural_row(v):
    return v.stored("neural_row", lambda: jobs.neural_job(rel.full_view(wide(v))).report("neural"))


def cohort_rows_of(v):
    return v.stored("neural_cohorts", lambda: jobs.neural_cohorts(v.train, v.test))


@query("mod_02_als")
def als(v):
    return als_scores(v)


@query("mod_03_als_lists")
def als_lists(v):
    return als_lists_of(v).select(ITEM).distinct()


@query("mod_04_content", uses="content_scored", sql="""
    SELECT user_id, business_id, rating, round(prediction, 6) AS prediction FROM content_scored""")
def content(v):
    return rounded(ContentModel().fit(v.reviews).predict(rel.triples(v.reviews)), PREDICTION)


SVDPP = SvdppModel()
LOGISTIC = LogisticModel()
K = 100

# Discounts that know the training ratings alone.
for _name in ("detail", "context", "aged", "decayed", "discounted"):
    _uses, _body = VIEWS[_name]
    for _old in ("ratings", "detail", "context", "aged", "decayed"):
        _new = "train" if _old == "ratings" else f"train_{_old}"
        _uses = " ".join(_new if u == _old else u for u in _uses.split())
        _body = _body.replace(f"FROM {_old}", f"FROM {_new}").replace(f"JOIN {_old} ", f"JOIN {_new} ")
    VIEWS[f"train_{_name}"] = (_uses, _body)
VIEWS |= factor_views.svdpp_views("train_discounted", "date_dist_rating", "sv", SVDPP)
VIEWS["sv_scored"] = factor_views.svdpp_scored("test", "sv", SVDPP)
VIEWS |= factor_views.logistic_views("train", "lg", LOGISTIC)
VIEWS["lg_scored"] = factor_views.logistic_scored("test", "lg", LOGISTIC)
_SCORED = "SELECT user_id, business_id, rating, round(prediction, 5) AS prediction FROM {}"


def fifth_place(df):
    """Twenty epochs add up rounding: five places are the same in both engines."""
    return df.withColumn(PREDICTION, F.round(PREDICTION, 5))


@query("mod_05_svdpp", _SCORED.format("sv_scored"), "sv_scored")
def svdpp(v):
    table = discount.export_columns(discount.discounted_detail(v.train, v.business))
    return fifth_place(SVDPP.fit(table, "date_dist_rating").predict(rel.triples(v.test)))


@query("mod_06_logistic", _SCORED.format("lg_scored"), "lg_scored")
def logistic(v):
    return fifth_place(LOGISTIC.fit(v.train).predict(rel.triples(v.test)))


@query("mod_07_neural")
def neural(v):
    return neural_scores(v)


@query("mod_08_interaction_matrix", uses="ratings", sql="""
    SELECT u.code AS row, i.code AS col, r.rating AS value, 1 AS mask FROM ratings r
    JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS code FROM (SELECT DISTINCT user_id FROM ratings)) u
      ON u.user_id = r.user_id
    JOIN (SELECT business_id, row_number() OVER (ORDER BY business_id) - 1 AS code
          FROM (SELECT DISTINCT business_id FROM ratings)) i ON i.business_id = r.business_id""")
def interaction_matrix(v):
    return rel.coordinates(jobs.encoded(rel.triples(v.ratings)), "user")


@query("met_17_model_coverage")
def model_coverage(v):
    return coverage.model_coverage(als_lists_of(v).select(ITEM).distinct(), v.train, v.test)


@query("tun_01_als_sweep")
def als_sweep(v):
    return als_grid(v)


for _epoch in range(1, LOGISTIC.epochs + 1):
    VIEWS |= factor_views.epoch_measures("lg", _epoch, LOGISTIC.factors, "train", "test", K, f"lg_at{_epoch}")
_SWEPT = ("train_auc_mean", "train_auc_std", "train_precision", "test_auc_mean", "test_auc_std", "test_precision")


@query("tun_03_epoch_sweep", " UNION ALL ".join(f"SELECT {e} AS epochs, {shown(*_SWEPT)}, prec_at_k FROM lg_at{e}"
                                                for e in range(1, LOGISTIC.epochs + 1)),
       " ".join(f"lg_at{e}" for e in range(1, LOGISTIC.epochs + 1)))
def epoch_sweep(v):
    return rounded(tuning.sweep_epochs(v.train.select(*PAIR), v.test.select(*PAIR), LOGISTIC.epochs, K, LOGISTIC), *_SWEPT)


@query("tun_04_neural_sweep")
def neural_sweep(v):
    return neural_grid(v)


@query("pip_01_discounted", uses="discounted", sql="""
    SELECT user_id, business_id, rating, round(date_rating, 6) AS date_rating, round(dist_rating, 6) AS dist_rating,
           round(date_dist_rating, 6) AS date_dist_rating FROM discounted""")
def discounted(v):
    return rounded(jobs.discounted_ratings(v.ratings, v.business), "date_rating", "dist_rating", "date_dist_rating")


@query("pip_02_wide", uses="wide", sql="""
    SELECT * REPLACE (round(stars, 6) AS stars, round(average_stars, 6) AS average_stars) FROM wide""")
def wide_features(v):
    return rounded(wide(v), "stars", "average_stars")


@query("pip_03_bias_report", standard_sql("bias"), "m_novelty m_serendipity m_rmse m_share")
def bias_report(v):
    return rounded(jobs.bias_job(v.train, v.test).report("bias"), *report.STANDARD)


@query("pip_04_als_report")
def als_report(v):
    return als_row(v)


def report_views(tag: str, source: str, scored: str) -> None:
    """The standard measures for another model: split of ``source``, predictions in ``scored``."""
    VIEWS[f"{tag}_test"] = (source, f"SELECT user_id, business_id, rating FROM {source} WHERE substr({_HASH}, 1, 12) >= 'cccccccccccc'")
    VIEWS[f"{tag}_means"] = (source, f"SELECT business_id, avg(rating) AS m FROM {source} GROUP BY business_id")
    VIEWS[f"{tag}_prob"] = (f"{tag}_means", f"""
        SELECT business_id, CASE WHEN n = 1 THEN 1.0::DOUBLE ELSE (n - rank) / CAST(nullif(n - 1, 0) AS DOUBLE) END AS prob
        FROM (SELECT business_id, row_number() OVER (ORDER BY round(m, 6) DESC, business_id) AS rank,
                     count(*) OVER () AS n FROM {tag}_means)""")
    VIEWS[f"{tag}_nov"] = (f"{scored} {tag}_prob", f"""
        SELECT p.user_id, log2(greatest(i.prob, 1e-100)) AS nov FROM {scored} p
        JOIN {tag}_prob i ON i.business_id = p.business_id""")
    VIEWS[f"{tag}_gain"] = (f"{scored} {tag}_test {tag}_prob", f"""
        SELECT r.user_id, greatest(CASE WHEN found = 1 THEN 1 ELSE (found - rank) / CAST(nullif(found - 1, 0) AS DOUBLE) END
                                   - prob, 0) AS gain
        FROM (SELECT p.user_id, p.business_id,
                     row_number() OVER (PARTITION BY p.user_id ORDER BY round(p.prediction, 6) DESC, p.business_id) AS rank,
                     count(*) OVER (PARTITION BY p.user_id) AS found
              FROM {scored} p JOIN {tag}_test t ON t.user_id = p.user_id AND t.business_id = p.business_id
              WHERE t.rating >= 1) r JOIN {tag}_prob i ON i.business_id = r.business_id""")


def report_sql(tag: str, source: str, scored: str, label: str) -> str:
    return f"""
        SELECT '{label}' AS model, {shown(*report.STANDARD)} FROM (SELECT
          (SELECT avg(nov) FROM {tag}_nov) AS avg_overall_novelty,
          (SELECT avg(m) FROM (SELECT avg(nov) AS m FROM {tag}_nov GROUP BY user_id)) AS avg_novelty,
          (SELECT avg(gain) FROM {tag}_gain) AS avg_overall_serendipity,
          (SELECT avg(m) FROM (SELECT avg(gain) AS m FROM {tag}_gain GROUP BY user_id)) AS avg_serendipity,
          (SELECT sqrt(avg(pow(p.prediction - a.rating, 2))) FROM {scored} p
           JOIN {source} a ON a.user_id = p.user_id AND a.business_id = p.business_id) AS rmse,
          (SELECT count(DISTINCT business_id) FROM {scored} WHERE prediction >= 1)
           / CAST((SELECT count(DISTINCT business_id) FROM {source}) AS DOUBLE) AS coverage)"""


report_views("ct", "reviews", "content_scored")


@query("pip_05_content_report", report_sql("ct", "reviews", "content_scored", "content"),
       "reviews content_scored ct_nov ct_gain")
def content_report(v):
    return rounded(jobs.content_job(v.reviews).report("content"), *report.STANDARD)


def sweep_views(tag: str, ngrams: int, sublinear: bool) -> str:
    """Views of one point of the content sweep; the name of its scored pairs."""
    VIEWS.update(tfidf_views(tag, ngrams, sublinear))
    for key, name in (("user_id", "u"), ("business_id", "i")):
        VIEWS[f"{tag}_{name}"] = (f"{tag} words", f"""
            SELECT t.{key}, t.term, sum(t.weight) / max(d.docs) AS weight FROM {tag} t
            JOIN (SELECT {key}, count(*) AS docs FROM words GROUP BY {key}) d ON d.{key} = t.{key} GROUP BY t.{key}, t.term""")
    VIEWS[f"{tag}_scored"] = (f"reviews {tag}_u {tag}_i", f"""
        SELECT r.user_id, r.business_id, r.rating, coalesce(c.prediction, 0) AS prediction FROM reviews r LEFT JOIN (
          SELECT p.user_id, p.business_id, sum(u.weight * i.weight) AS prediction
          FROM (SELECT DISTINCT user_id, business_id FROM reviews) p JOIN {tag}_u u ON u.user_id = p.user_id
          JOIN {tag}_i i ON i.business_id = p.business_id AND i.term = u.term GROUP BY p.user_id, p.business_id) c
        ON c.user_id = r.user_id AND c.business_id = r.business_id""")
    report_views(tag, "reviews", f"{tag}_scored")
    return f"{tag}_scored"


_POINTS = [(f"cs{n}{'s' if sub else 'p'}", n, sub) for n in (1, 5, 10) for sub in (True, False)]


@query("tun_02_content_sweep", " UNION ALL ".join(
    report_sql(tag, "reviews", sweep_views(tag, n, sub), f"ngram_range = (1, {n}), sublinear_tf = {sub}") for tag, n, sub in _POINTS),
    " ".join(f"reviews {tag}_scored {tag}_nov {tag}_gain" for tag, _, _ in _POINTS))
def content_sweep(v):
    return rounded(tuning.sweep_content(v.reviews), *report.STANDARD)


VIEWS["disc_rated"] = ("discounted", "SELECT user_id, business_id, date_dist_rating AS rating FROM discounted")
report_views("dr", "disc_rated", "dr_scored")
VIEWS["dr_train"] = ("disc_rated", f"SELECT * FROM disc_rated WHERE substr({_HASH}, 1, 12) < 'cccccccccccc'")
VIEWS |= factor_views.svdpp_views("dr_train", "rating", "dv", SVDPP)
VIEWS["dr_scored"] = factor_views.svdpp_scored("dr_test", "dv", SVDPP)


@query("pip_06_discounted_report", report_sql("dr", "disc_rated", "dr_scored", "svdpp").replace(", 6)", ", 5)"),
       "disc_rated dr_scored dr_nov dr_gain")
def discounted_report(v):
    row = jobs.discounted_job(v.ratings, v.business, SVDPP).report("svdpp")
    return row.withColumns({c: F.round(c, 5) for c in report.STANDARD})


@query("pip_07_neural_report")
def neural_report(v):
    return neural_row(v)


@query("pip_07_neural_cohorts")
def neural_cohorts(v):
    return cohort_rows_of(v)


# The job numbers users and items before it splits.
VIEWS["coded"] = ("ratings", """
    SELECT u.code AS user_id, i.code AS business_id, r.rating FROM ratings r
    JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS code FROM (SELECT DISTINCT user_id FROM ratings)) u
      ON u.user_id = r.user_id
    JOIN (SELECT business_id, row_number() OVER (ORDER BY business_id) - 1 AS code
          FROM (SELECT DISTINCT business_id FROM ratings)) i ON i.business_id = r.business_id""")
VIEWS["coded_train"] = ("coded", f"SELECT * FROM coded WHERE substr({_HASH}, 1, 12) < 'cccccccccccc'")
VIEWS["coded_test"] = ("coded", f"SELECT * FROM coded WHERE substr({_HASH}, 1, 12) >= 'cccccccccccc'")
VIEWS |= factor_views.logistic_views("coded_train", "cl", LOGISTIC)
VIEWS |= factor_views.epoch_measures("cl", LOGISTIC.epochs, LOGISTIC.factors, "coded_train", "coded_test", K, "cl_last")


@query("pip_08_interaction_report", f"SELECT {shown(*_SWEPT)}, prec_at_k FROM cl_last", "cl_last")
def interaction_report(v):
    return rounded(jobs.interaction_job(v.ratings, LOGISTIC, K), *_SWEPT)
