"""SQL text of the fixture views, put together as common table expressions."""

from __future__ import annotations

from collections.abc import Iterable

from ratecraft.fixtures import COMPLIMENT_MODULI
from ratecraft.functions.text import STOP_WORDS, TOKEN

_DIGEST = "md5(concat(CAST(user_id AS VARCHAR), ':', CAST(business_id AS VARCHAR)))"

#: name -> (views it reads, body)
VIEWS: dict[str, tuple[str, str]] = {
    "interactions": ("", """
        SELECT o.o_custkey AS user_id, l.l_suppkey AS business_id,
               CAST(ceil(l.l_quantity / 10) AS DOUBLE) AS rating, o.o_orderdate AS date
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    "ratings": ("interactions", """
        SELECT user_id, business_id, rating, date FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, business_id ORDER BY date DESC, rating DESC) AS rn
          FROM interactions) WHERE rn = 1"""),
    "train": ("ratings", f"SELECT * FROM ratings WHERE substr({_DIGEST}, 1, 12) < 'cccccccccccc'"),
    "test": ("ratings", f"SELECT * FROM ratings WHERE substr({_DIGEST}, 1, 12) >= 'cccccccccccc'"),
    "business": ("interactions", """
        SELECT s.s_name AS name, s.s_suppkey AS business_id,
               concat('no ', CAST(s.s_suppkey AS VARCHAR)) AS address, n.n_name AS city, r.r_name AS state,
               CASE WHEN s.s_suppkey % 11 = 0 THEN NULL ELSE CAST(n.n_nationkey AS VARCHAR) END AS postal_code,
               CAST(25.0 + n.n_nationkey + (s.s_suppkey % 10) * 0.05 AS DOUBLE) AS latitude,
               CAST(-120.0 + 2 * n.n_nationkey + (s.s_suppkey % 7) * 0.05 AS DOUBLE) AS longitude,
               round(a.mean_rating * 2) / 2 AS stars, a.n AS review_count,
               CASE WHEN s.s_suppkey % 5 = 0 THEN 0 ELSE 1 END AS is_open
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey
        LEFT JOIN (SELECT business_id, avg(rating) AS mean_rating, count(*) AS n
                   FROM interactions GROUP BY business_id) a ON a.business_id = s.s_suppkey"""),
    "users": ("interactions", f"""
        SELECT c.c_name AS name, c.c_custkey AS user_id, coalesce(a.n, 0) AS review_count,
               a.first_date AS yelping_since,
               c.c_custkey % 101 AS useful, c.c_custkey % 67 AS funny, c.c_custkey % 83 AS cool,
               CASE WHEN c.c_custkey % 9 = 0 THEN '2017' ELSE '' END AS elite,
               c.c_custkey % 37 AS fans, a.mean_rating AS average_stars,
               {", ".join(f"c.c_custkey % {m} AS compliment_{kind}" for kind, m in COMPLIMENT_MODULI.items())}
        FROM customer c
        LEFT JOIN (SELECT user_id, count(*) AS n, min(date) AS first_date, avg(rating) AS mean_rating
                   FROM interactions GROUP BY user_id) a ON a.user_id = c.c_custkey"""),
    "tip": ("ratings", """
        SELECT r.business_id, r.user_id, d.text, r.date, (r.user_id + r.business_id) % 3 AS compliment_count
        FROM ratings r JOIN documents d ON d.doc_id = (r.user_id * 31 + r.business_id) % (SELECT count(*) FROM documents)
        WHERE (r.user_id + r.business_id) % 4 = 0"""),
    "reviews": ("", """
        SELECT doc_id, doc_id % greatest(40, (SELECT count(*) FROM documents) // 10) AS user_id,
               (doc_id * 7 + doc_id % 3) % greatest(25, (SELECT count(*) FROM documents) // 20) AS business_id,
               CAST(1 + n_chars % 5 AS DOUBLE) AS rating, text,
               TIMESTAMP '2015-01-01 00:00:00' + to_days(CAST(doc_id % 1000 AS INTEGER)) AS date
        FROM documents"""),
    "photos": ("", """
        SELECT url AS caption, concat('p', CAST(page_id AS VARCHAR)) AS photo_id, page_id % greatest(25, (SELECT count(*) FROM pages) // 10) AS business_id,
               CASE page_id % 3 WHEN 0 THEN 'food' WHEN 1 THEN 'inside' ELSE 'outside' END AS label
        FROM pages"""),
    "item_content": ("", "SELECT vec_id AS business_id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings"),
    "item_categories": ("business", """
        SELECT business_id, [1.0::DOUBLE, (business_id % 2 = 0)::INT::DOUBLE, (business_id % 3 = 0)::INT::DOUBLE,
               (business_id % 5 = 0)::INT::DOUBLE, (business_id % 7 = 0)::INT::DOUBLE] AS features
        FROM business"""),
    "corpus": ("train test", """
        SELECT user_id, business_id, rating FROM train UNION ALL SELECT user_id, business_id, rating FROM test"""),
    "detail": ("ratings business", """
        SELECT r.*, b.name, b.address, b.city, b.state, b.postal_code, b.latitude, b.longitude, b.stars,
               b.review_count, b.is_open
        FROM ratings r LEFT JOIN business b ON r.business_id = b.business_id"""),
    "context": ("detail", """
        SELECT user_id, avg(latitude) AS mean_lat, avg(longitude) AS mean_long, max(date) AS last_date
        FROM detail GROUP BY user_id"""),
    "aged": ("detail context", """
        SELECT d.*, c.mean_lat, c.mean_long, c.last_date,
               (c.mean_lat - d.latitude) * (c.mean_lat - d.latitude)
                 + (c.mean_long - d.longitude) * (c.mean_long - d.longitude) AS distance,
               floor((epoch(c.last_date) - epoch(d.date)) / 86400) / CAST(30 AS DOUBLE) AS date_diff
        FROM detail d JOIN context c ON d.user_id = c.user_id"""),
    "decayed": ("aged", """
        SELECT *, exp(1 / (1 + distance)) / exp(1.0) AS dist_scale,
               exp(1 / (1 + ln(date_diff + 1))) / exp(1.0) AS date_scale FROM aged"""),
    "discounted": ("decayed", """
        SELECT *, rating * date_scale AS date_rating, rating * dist_scale AS dist_rating,
               date_scale * dist_scale * rating AS date_dist_rating FROM decayed"""),
    "wide": ("ratings business users tip", f"""
        SELECT r.user_id, r.business_id, r.rating, r.date, b.name AS name_x, b.address, b.city, b.state,
               b.postal_code, b.latitude, b.longitude, b.stars, b.review_count AS review_count_x, b.is_open,
               u.name AS name_y, u.review_count AS review_count_y, u.yelping_since, u.useful, u.funny, u.cool,
               u.elite, u.fans, u.average_stars, {", ".join(f"u.compliment_{k}" for k in COMPLIMENT_MODULI)},
               t.text, t.compliment_count
        FROM ratings r LEFT JOIN business b ON r.business_id = b.business_id
        LEFT JOIN users u ON r.user_id = u.user_id
        LEFT JOIN tip t ON t.business_id = r.business_id AND t.user_id = r.user_id AND t.date = r.date"""),
    "words": ("reviews", f"""
        SELECT doc_id, user_id, business_id, list_filter(regexp_extract_all(lower(text), '{TOKEN}'),
               lambda w: NOT (w IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}))) AS words FROM reviews"""),
}


def bias_views(source: str, prefix: str, epochs: int = 10, reg_item: int = 10, reg_user: int = 15) -> dict:
    """Views of a bias fit on ``source``: one pair of tables per epoch, last as <prefix>_u and <prefix>_i."""
    out = {f"{prefix}_mu": (source, f"SELECT avg(rating) AS mu FROM {source}"),
           f"{prefix}_dev": (f"{source} {prefix}_mu", f"SELECT user_id, business_id, rating - mu AS dev "
                                                       f"FROM {source}, {prefix}_mu")}
    last = None
    for e in range(1, epochs + 1):
        done = e == epochs
        item, user = (f"{prefix}_i", f"{prefix}_u") if done else (f"{prefix}_i{e}", f"{prefix}_u{e}")
        join = f"JOIN {last} u ON u.user_id = d.user_id" if last else ""
        minus = "d.dev - u.b_u" if last else "d.dev"
        out[item] = (f"{prefix}_dev" + (f" {last}" if last else ""), f"""
            SELECT d.business_id, sum({minus}) / ({reg_item} + count(*)) AS b_i FROM {prefix}_dev d {join}
            GROUP BY d.business_id""")
        out[user] = (f"{prefix}_dev {item}", f"""
            SELECT d.user_id, sum(d.dev - i.b_i) / ({reg_user} + count(*)) AS b_u
            FROM {prefix}_dev d JOIN {item} i ON i.business_id = d.business_id GROUP BY d.user_id""")
        last = user
    return out


def bias_scored(pairs: str, prefix: str) -> str:
    return f"""
        SELECT t.user_id, t.business_id, t.rating,
               least(greatest(m.mu + coalesce(u.b_u, 0) + coalesce(i.b_i, 0), 1), 5) AS prediction
        FROM {pairs} t CROSS JOIN {prefix}_mu m LEFT JOIN {prefix}_u u ON u.user_id = t.user_id
        LEFT JOIN {prefix}_i i ON i.business_id = t.business_id"""


VIEWS |= bias_views("train", "bias")
VIEWS["predictions"] = ("test bias_mu bias_u bias_i", bias_scored("test", "bias"))
VIEWS["ranked"] = ("predictions", """
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(prediction, 6) DESC, business_id) AS rank
    FROM predictions""")
VIEWS["top10"] = ("ranked", "SELECT user_id, business_id, rating, prediction FROM ranked WHERE rank <= 10")
VIEWS["item_means"] = ("corpus", """
    SELECT business_id, avg(rating) AS avg_rating FROM corpus GROUP BY business_id""")
VIEWS["item_rank"] = ("item_means", """
    SELECT business_id, avg_rating, row_number() OVER (ORDER BY round(avg_rating, 6) DESC, business_id) AS rank,
           count(*) OVER () AS n FROM item_means""")
VIEWS["item_prob"] = ("item_rank", """
    SELECT business_id, CASE WHEN n = 1 THEN 1.0::DOUBLE ELSE (n - rank) / CAST(n - 1 AS DOUBLE) END AS prob
    FROM item_rank""")

VIEWS["per_item"] = ("train", "SELECT business_id, count(*) AS n FROM train GROUP BY business_id")
VIEWS["per_user"] = ("train", "SELECT user_id, count(*) AS n FROM train GROUP BY user_id")
VIEWS["cuts"] = ("per_item per_user", """
    SELECT (SELECT quantile_cont(n, 0.2) FROM per_item) AS item_low, (SELECT quantile_cont(n, 0.8) FROM per_item) AS item_high,
           (SELECT quantile_cont(n, 0.2) FROM per_user) AS user_low, (SELECT quantile_cont(n, 0.8) FROM per_user) AS user_high""")
VIEWS["recent"] = ("test", """
    SELECT user_id, business_id, rating FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC, business_id DESC) AS rn FROM test)
    WHERE rn = 1""")
_SMALL = "SELECT t.user_id, t.business_id, t.rating, '{name}' AS cohort FROM test t, cuts c, {table} k WHERE k.{key} = t.{key} AND k.n {test}"
VIEWS["cohort_rows"] = ("test cuts per_item per_user recent", " UNION ALL ".join((
    _SMALL.format(name="test_least_items", table="per_item", key="business_id", test="<= c.item_low"),
    _SMALL.format(name="test_most_items", table="per_item", key="business_id", test=">= c.item_high"),
    "SELECT user_id, business_id, rating, 'test_mostrecent' AS cohort FROM recent",
    _SMALL.format(name="test_nonprolific_users", table="per_user", key="user_id", test="<= c.user_low"),
    _SMALL.format(name="test_prolific_users", table="per_user", key="user_id", test=">= c.user_high"))))


def tfidf_views(prefix: str, ngrams: int = 1, sublinear: bool = True) -> dict:
    """Views <prefix>_tf (doc_id, user_id, business_id, term, tf) and <prefix> with the normalised weight."""
    runs = ["SELECT doc_id, user_id, business_id, unnest(words) AS term FROM words"]
    for n in range(2, ngrams + 1):
        joined = " || ' ' || ".join(f"words[i + {j}]" for j in range(n))
        runs.append(f"SELECT doc_id, user_id, business_id, unnest(list_transform(range(1, len(words) - {n} + 2), "
                    f"lambda i: {joined})) FROM words")
    tf = "1 + ln(t.tf)" if sublinear else "t.tf"
    return {
        f"{prefix}_tf": ("words", "SELECT doc_id, user_id, business_id, term, count(*) AS tf FROM ("
                         + " UNION ALL ".join(runs) + ") GROUP BY ALL"),
        f"{prefix}_df": (f"{prefix}_tf", f"SELECT term, count(*) AS df FROM {prefix}_tf GROUP BY term"),
        f"{prefix}_raw": (f"{prefix}_tf {prefix}_df", f"""
            SELECT t.*, ({tf}) * (ln((1 + (SELECT count(*) FROM words)) / CAST(1 + d.df AS DOUBLE)) + 1) AS raw
            FROM {prefix}_tf t JOIN {prefix}_df d ON d.term = t.term"""),
        prefix: (f"{prefix}_raw", f"""
            SELECT doc_id, user_id, business_id, term,
                   raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM {prefix}_raw""")}


VIEWS |= tfidf_views("tfidf")


def with_views(names: Iterable[str], select: str) -> str:
    """``WITH`` list of the named views and all they read, each written once, then ``select``."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for needed in VIEWS[name][0].split():
            if needed in VIEWS:
                add(needed)
        order.append(name)

    for name in names:
        add(name)
    if not order:
        return select.strip()
    parts = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name][1].strip()})" for name in order)
    body = select.strip()
    # A select that brings its own WITH list continues ours.
    return f"WITH {parts},\n{body[5:].strip()}" if body[:5].upper() == "WITH " else f"WITH {parts}\n{body}"
