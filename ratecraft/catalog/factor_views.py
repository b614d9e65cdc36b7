"""SQL text of the factor models: every epoch as a handful of views, with a column for each factor."""

from __future__ import annotations

from ratecraft.models.factor import LogisticModel, SvdppModel


def _number(*parts: str) -> str:
    text = ", ':', ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(concat('0x', substr(md5(concat({text})), 1, 12)) AS BIGINT)"


def _start(key: str, seed: int, j: int, scale: float = 0.1) -> str:
    return f"({_number(key, str(seed), str(j))} / 281474976710656.0::DOUBLE - 0.5::DOUBLE) * {2 * scale}::DOUBLE"


def _moved(old: str, gradient: str, n: str, lr: float, reg: float, damping: float = 1.0) -> str:
    return f"{old} + {lr}::DOUBLE * ({gradient} - {reg}::DOUBLE * {n} * {old}) / (1 + {damping * lr}::DOUBLE * {n})"


def _list(form: str, k: int) -> str:
    return ", ".join(form.format(j=j) for j in range(k))


def _sum(form: str, k: int) -> str:
    return " + ".join(form.format(j=j) for j in range(k))


def logistic_views(source: str, tag: str, model: LogisticModel) -> dict[str, tuple[str, str]]:
    """<tag>_u<epoch> (user_id, bu, p0..) and <tag>_i<epoch> (business_id, bi, q0..), from epoch 0 on."""
    k = model.factors
    draws = " UNION ALL ".join(f"""
        SELECT p.user_id, c.business_id FROM {tag}_pos p JOIN {tag}_codes c
        ON c.code = {_number("p.user_id", "p.business_id", str(d), str(model.seed))} % (SELECT count(*) FROM {tag}_codes)"""
                               for d in range(model.negatives))
    out = {
        f"{tag}_pos": (source, f"SELECT DISTINCT user_id, business_id FROM {source}"),
        f"{tag}_codes": (f"{tag}_pos", f"""
            SELECT business_id, row_number() OVER (ORDER BY business_id) - 1 AS code
            FROM (SELECT DISTINCT business_id FROM {tag}_pos)"""),
        f"{tag}_rows": (f"{tag}_pos {tag}_codes", f"""
            SELECT user_id, business_id, 1 AS label FROM {tag}_pos UNION ALL
            SELECT DISTINCT n.user_id, n.business_id, 0 FROM ({draws}) n
            WHERE NOT EXISTS (SELECT 1 FROM {tag}_pos p WHERE p.user_id = n.user_id AND p.business_id = n.business_id)"""),
        f"{tag}_u0": (f"{tag}_rows", f"SELECT user_id, 0.0::DOUBLE AS bu, {', '.join(f'{_start("user_id", model.seed, j)} AS p{j}' for j in range(k))} "
                                     f"FROM (SELECT DISTINCT user_id FROM {tag}_rows)"),
        f"{tag}_i0": (f"{tag}_rows", f"SELECT business_id, 0.0::DOUBLE AS bi, {', '.join(f'{_start("business_id", model.seed + 1, j)} AS q{j}' for j in range(k))} "
                                     f"FROM (SELECT DISTINCT business_id FROM {tag}_rows)")}

    def half(users: str, items: str, key: str, bias: str, own: str, other: str) -> str:
        table = users if key == "user_id" else items
        return f"""
            SELECT t.{key}, {_moved(f"t.{bias}", "g.ge", "g.n", model.lr, 0.0)} AS {bias},
                   {", ".join(f"{_moved(f't.{own}{j}', f'g.g{j}', 'g.n', model.lr, model.reg)} AS {own}{j}" for j in range(k))}
            FROM {table} t JOIN (
              SELECT {key}, count(*) AS n, sum(e) AS ge, {_list("sum(e * " + other + "{j}) AS g{j}", k)} FROM (
                SELECT r.{key}, r.label - 1 / (1 + exp(-(u.bu + i.bi + {_sum("u.p{j} * i.q{j}", k)}))) AS e, {_list(other + "{j}", k)}
                FROM {tag}_rows r JOIN {users} u ON u.user_id = r.user_id JOIN {items} i ON i.business_id = r.business_id)
              GROUP BY {key}) g ON g.{key} = t.{key}"""

    for e in range(1, model.epochs + 1):
        u, i, last = f"{tag}_u{e}", f"{tag}_i{e}", f"{tag}_i{e - 1}"
        out[u] = (f"{tag}_rows {tag}_u{e - 1} {last}", half(f"{tag}_u{e - 1}", last, "user_id", "bu", "p", "q"))
        out[i] = (f"{tag}_rows {u} {last}", half(u, last, "business_id", "bi", "q", "p"))
    return out


def logistic_scored(pairs: str, tag: str, model: LogisticModel) -> tuple[str, str]:
    e, k = model.epochs, model.factors
    return f"{pairs} {tag}_u{e} {tag}_i{e}", f"""
        SELECT t.user_id, t.business_id, t.rating, u.bu + i.bi + {_sum("u.p{j} * i.q{j}", k)} AS prediction
        FROM {pairs} t JOIN {tag}_u{e} u ON u.user_id = t.user_id JOIN {tag}_i{e} i ON i.business_id = t.business_id"""


def svdpp_views(source: str, target: str, tag: str, model: SvdppModel) -> dict[str, tuple[str, str]]:
    """<tag>_w<epoch> (user_id, bu, n, root, p.., w..) and <tag>_i<epoch> (business_id, m, c, bi, q.., y..)."""
    k = model.factors
    items0 = ", ".join(f"{_start('business_id', model.seed + 1, j)} AS q{j}, {_start('business_id', model.seed + 2, j)} AS y{j}" for j in range(k))
    out = {
        f"{tag}_rows": (source, f"SELECT user_id, business_id, {target} AS r FROM {source}"),
        f"{tag}_span": (f"{tag}_rows", f"SELECT avg(r) AS mean, min(r) AS low, max(r) AS high FROM {tag}_rows"),
        f"{tag}_u0": (f"{tag}_rows", f"""
            SELECT user_id, n, 1 / sqrt(n) AS root, 0.0::DOUBLE AS bu, {", ".join(f"{_start('user_id', model.seed, j)} AS p{j}" for j in range(k))}
            FROM (SELECT user_id, count(*) AS n FROM {tag}_rows GROUP BY user_id)"""),
        f"{tag}_i0": (f"{tag}_rows {tag}_u0", f"""
            SELECT business_id, m, c, 0.0::DOUBLE AS bi, {items0} FROM (
              SELECT r.business_id, count(*) AS m, sum(u.n) AS c FROM {tag}_rows r JOIN {tag}_u0 u ON u.user_id = r.user_id
              GROUP BY r.business_id)""")}
    error = f"r.r - ((SELECT mean FROM {tag}_span) + w.bu + i.bi + {_sum('i.q{j} * w.w{j}', k)})"

    def moved(old: str, gradient: str, n: str) -> str:
        return _moved(old, gradient, n, model.lr, model.reg, model.damping)

    for e in range(model.epochs + 1):
        users, items, whole = f"{tag}_u{e}", f"{tag}_i{e}", f"{tag}_w{e}"
        out[whole] = (f"{tag}_rows {users} {items}", f"""
            SELECT u.*, {_list("u.p{j} + u.root * z.z{j} AS w{j}", k)} FROM {users} u JOIN (
              SELECT r.user_id, {_list("sum(i.y{j}) AS z{j}", k)} FROM {tag}_rows r JOIN {items} i ON i.business_id = r.business_id
              GROUP BY r.user_id) z ON z.user_id = u.user_id""")
        if e == model.epochs:
            break
        known = f"{tag}_k{e}"
        out[known] = (f"{tag}_rows {tag}_span {whole} {items}", f"""
            SELECT w.*, g.ge, {_list("g.g{j}", k)} FROM {whole} w JOIN (
              SELECT user_id, sum(e) AS ge, {_list("sum(e * q{j}) AS g{j}", k)} FROM (
                SELECT r.user_id, {error} AS e, {_list("i.q{j}", k)} FROM {tag}_rows r
                JOIN {whole} w ON w.user_id = r.user_id JOIN {items} i ON i.business_id = r.business_id)
              GROUP BY user_id) g ON g.user_id = w.user_id""")
        out[f"{tag}_u{e + 1}"] = (known, f"""
            SELECT user_id, n, root, {moved("bu", "ge", "n")} AS bu, {", ".join(f"{moved(f'p{j}', f'g{j}', 'n')} AS p{j}" for j in range(k))}
            FROM {known}""")
        out[f"{tag}_i{e + 1}"] = (f"{tag}_rows {tag}_span {known} {items}", f"""
            SELECT i.business_id, i.m, i.c, {moved("i.bi", "h.he", "i.m")} AS bi,
                   {", ".join(f"{moved(f'i.q{j}', f'h.h{j}', 'i.m')} AS q{j}, {moved(f'i.y{j}', f'h.i{j}', 'i.c')} AS y{j}" for j in range(k))}
            FROM {items} i JOIN (
              SELECT business_id, sum(e) AS he, {_list("sum(e * w{j}) AS h{j}, sum(root * g{j}) AS i{j}", k)} FROM (
                SELECT r.business_id, {error} AS e, w.root, {_list("w.w{j}, w.g{j}", k)} FROM {tag}_rows r
                JOIN {known} w ON w.user_id = r.user_id JOIN {items} i ON i.business_id = r.business_id)
              GROUP BY business_id) h ON h.business_id = i.business_id""")
    return out


def svdpp_scored(pairs: str, tag: str, model: SvdppModel) -> tuple[str, str]:
    e, k = model.epochs, model.factors
    return f"{pairs} {tag}_span {tag}_w{e} {tag}_i{e}", f"""
        SELECT t.user_id, t.business_id, t.rating,
               least(greatest(s.mean + coalesce(w.bu, 0) + coalesce(i.bi, 0) + coalesce({_sum("i.q{j} * w.w{j}", k)}, 0), s.low), s.high) AS prediction
        FROM {pairs} t CROSS JOIN {tag}_span s LEFT JOIN {tag}_w{e} w ON w.user_id = t.user_id
        LEFT JOIN {tag}_i{e} i ON i.business_id = t.business_id"""


def epoch_measures(tag: str, epoch: int, factors: int, train: str, test: str, k: int, prefix: str) -> dict[str, tuple[str, str]]:
    """The catalogue is all items of the model; pairs of ``exclude`` that are no positives are left out.

    <prefix>: mean and deviation of the users' AUC and mean precision at k on train and on test after an epoch."""
    u, i = f"{tag}_u{epoch}", f"{tag}_i{epoch}"
    out: dict[str, tuple[str, str]] = {}
    parts = []
    for part, positive, exclude in (("train", train, None), ("test", test, train)):
        skip = (f"WHERE NOT EXISTS (SELECT 1 FROM {exclude} r WHERE r.user_id = s.user_id AND r.business_id = s.business_id)"
                f" OR t.user_id IS NOT NULL") if exclude else ""
        name = f"{prefix}_{part}"
        out[name] = (f"{u} {i} {positive} {exclude or ''}".strip(), f"""
            SELECT s.user_id, s.business_id, s.score, CASE WHEN t.user_id IS NULL THEN 0 ELSE 1 END AS hit FROM (
              SELECT u.user_id, i.business_id, i.bi + {_sum("u.p{j} * i.q{j}", factors)} AS score
              FROM {u} u CROSS JOIN {i} i WHERE u.user_id IN (SELECT user_id FROM {positive})) s
            LEFT JOIN (SELECT DISTINCT user_id, business_id FROM {positive}) t
              ON t.user_id = s.user_id AND t.business_id = s.business_id {skip}""")
        out[f"{name}_users"] = (name, f"""
            SELECT user_id, coalesce((sum(CASE WHEN hit = 1 THEN mid END) - sum(hit) * (sum(hit) + 1) / 2.0::DOUBLE)
                     / CAST(nullif(sum(hit) * (count(*) - sum(hit)), 0) AS DOUBLE), 0.5) AS auc,
                   sum(CASE WHEN place <= {k} THEN hit ELSE 0 END) / {float(k)}::DOUBLE AS precision
            FROM (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY score)
                           + (count(*) OVER (PARTITION BY user_id, score) - 1) / 2.0::DOUBLE AS mid,
                         row_number() OVER (PARTITION BY user_id ORDER BY score DESC, business_id) AS place FROM {name})
            GROUP BY user_id HAVING sum(hit) > 0""")
        parts.append(f"""(SELECT avg(auc) FROM {name}_users) AS {part}_auc_mean, (SELECT stddev_pop(auc) FROM {name}_users) AS {part}_auc_std,
            (SELECT avg(precision) FROM {name}_users) AS {part}_precision""")
    out[prefix] = (f"{prefix}_train_users {prefix}_test_users", f"SELECT {', '.join(parts)}, {k} AS prec_at_k")
    return out

