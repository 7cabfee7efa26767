"""SQL that refits the closed-form models, for checking fitted results.

Every function returns common table expressions over a source with the columns
``grp`` (one fit per group), ``is_train``, the inputs and the target.
"""

from __future__ import annotations

from collections.abc import Sequence


def prepared(
    name: str,
    source: str,
    numeric: Sequence[str],
    texts: Sequence[tuple[str, str]],
    target: str,
    keep: Sequence[str] = (),
) -> str:
    """x1.. = inputs standardised with train statistics, then one 0/1 column per text value."""
    stats = ", ".join(
        f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(numeric, 1)
    )
    xs = [f"({c} - m{i}) / s{i} AS x{i}" for i, c in enumerate(numeric, 1)]
    xs += [
        f"CASE WHEN {c} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS x{i}"
        for i, (c, v) in enumerate(texts, len(numeric) + 1)
    ]
    kept = "".join(f"{k}, " for k in keep)
    return f"""{name}_s AS MATERIALIZED (SELECT grp, {stats} FROM {source} WHERE is_train GROUP BY grp),
{name} AS MATERIALIZED (SELECT grp, is_train, {kept}{target}::DOUBLE AS y, {', '.join(xs)}
  FROM {source} JOIN {name}_s USING (grp))"""


def monomials(inputs: int, degree: int, binary: Sequence[int]) -> list[str]:
    """Products of x1..xk up to a degree; a 0/1 input never appears squared, since its
    square is itself."""
    out: list[tuple[int, ...]] = [()]
    for _ in range(degree):
        out += [
            (*t, j)
            for t in list(out)
            for j in range(1, inputs + 1)
            if not t or j > t[-1] or (j == t[-1] and j not in binary)
        ]
    terms = sorted({t for t in out if t}, key=lambda t: (len(t), t))
    return [" * ".join(f"x{j}" for j in t) for t in terms]


def _cell(i: int, j: int) -> str:
    return f"c{max(i, j)}_{min(i, j)}"


def _cholesky(k: int, matrix, right) -> list[list[str]]:
    """Layers of select items solving a symmetric system: the last ones give b1..bk."""
    layers = []
    for j in range(1, k + 1):
        own = "".join(f" - l{j}_{m} * l{j}_{m}" for m in range(1, j))
        layers.append([f"sqrt({matrix(j, j)}{own}) AS l{j}_{j}"])
        below = []
        for i in range(j + 1, k + 1):
            cross = "".join(f" - l{i}_{m} * l{j}_{m}" for m in range(1, j))
            below.append(f"({matrix(i, j)}{cross}) / l{j}_{j} AS l{i}_{j}")
        if below:
            layers.append(below)
    for i in range(1, k + 1):
        known = "".join(f" - l{i}_{m} * f{m}" for m in range(1, i))
        layers.append([f"({right(i)}{known}) / l{i}_{i} AS f{i}"])
    for i in range(k, 0, -1):
        known = "".join(f" - l{m}_{i} * b{m}" for m in range(i + 1, k + 1))
        layers.append([f"(f{i}{known}) / l{i}_{i} AS b{i}"])
    return layers


def _layered(name: str, source: str, layers: list[list[str]]) -> str:
    """One materialised step per layer: later items see the columns of earlier ones."""
    parts, last = [], source
    for t, items in enumerate(layers):
        step = name if t == len(layers) - 1 else f"{name}_{t}"
        parts.append(f"{step} AS MATERIALIZED (SELECT *, {', '.join(items)} FROM {last})")
        last = step
    return ",\n".join(parts)


def _moments(name: str, rows: str, terms: Sequence[str]) -> str:
    k = len(terms)
    zs = ", ".join(f"{t} AS z{i}" for i, t in enumerate(terms, 1))
    cov = [f"avg(z{i}) AS a{i}, covar_pop(z{i}, y) AS r{i}" for i in range(1, k + 1)]
    cov += [f"covar_pop(z{i}, z{j}) AS c{i}_{j}" for i in range(1, k + 1) for j in range(1, i + 1)]
    return f"""{name}_z AS MATERIALIZED (SELECT *, {zs} FROM {rows}),
{name}_m AS MATERIALIZED (SELECT grp, count(*) AS n, avg(y) AS ay, {', '.join(cov)}
  FROM {name}_z WHERE is_train GROUP BY grp)"""


def _predicted(name: str, k: int) -> str:
    centre = " - ".join(["ay", *[f"b{i} * a{i}" for i in range(1, k + 1)]])
    line = " + ".join(["b0", *[f"b{i} * z{i}" for i in range(1, k + 1)]])
    bs = ", ".join(f"b{i}" for i in range(1, k + 1))
    return f"""{name}_b AS MATERIALIZED (SELECT grp, {bs}, {centre} AS b0 FROM {name}_f),
{name} AS MATERIALIZED (SELECT z.*, {line} AS p FROM {name}_z z JOIN {name}_b USING (grp))"""


def least_squares(name: str, rows: str, terms: Sequence[str], ridge: float = 0.0) -> str:
    """``{name}`` = rows with prediction p; ``{name}_b`` = coefficients b0..bk per group."""
    k = len(terms)

    def cell(i: int, j: int) -> str:
        return f"({_cell(i, j)} + {ridge!r}::DOUBLE / n)" if i == j and ridge else _cell(i, j)

    solve = _layered(f"{name}_f", f"{name}_m", _cholesky(k, cell, lambda i: f"r{i}"))
    return f"{_moments(name, rows, terms)},\n{solve},\n{_predicted(name, k)}"


def elastic_net(name: str, rows: str, terms: Sequence[str], alpha: float, ratio: float, sweeps: int = 10) -> str:
    """Coordinate descent written out sweep by sweep."""
    k = len(terms)
    current = {i: "0.0::DOUBLE" for i in range(1, k + 1)}
    layers = []
    for s in range(sweeps):
        for j in range(1, k + 1):
            rest = "".join(f" - {_cell(i, j)} * {current[i]}" for i in range(1, k + 1) if i != j)
            g = f"g{s}_{j}"
            layers.append([f"r{j}{rest} AS {g}"])
            new = f"v{s}_{j}"
            layers.append(
                [f"sign({g}) * greatest(abs({g}) - {alpha * ratio!r}, 0) / (c{j}_{j} + {alpha * (1 - ratio)!r}) AS {new}"]
            )
            current[j] = new
    layers.append([f"{current[i]} AS b{i}" for i in range(1, k + 1)])
    solve = _layered(f"{name}_f", f"{name}_m", layers)
    return f"{_moments(name, rows, terms)},\n{solve},\n{_predicted(name, k)}"


def penalty_points(name: str, rows: str, terms: Sequence[str], points: Sequence[tuple], sweeps: int = 12) -> str:
    """``{name}`` = rows with predictions p for every point (model, point, ridge, l1, l2).

    One table of moments serves all points: those without l1 are solved directly, the others by
    coordinate descent written out sweep by sweep.
    """
    k = len(terms)
    values = ", ".join(f"('{m}', {i}, {r!r}::DOUBLE, {a!r}::DOUBLE, {b!r}::DOUBLE)" for m, i, r, a, b in points)

    def cell(i: int, j: int) -> str:
        return f"({_cell(i, j)} + ridge / n + l2)" if i == j else _cell(i, j)

    direct = _layered(f"{name}_q", f"{name}_mq", _cholesky(k, cell, lambda i: f"r{i}"))
    current, layers = {i: "0.0::DOUBLE" for i in range(1, k + 1)}, []
    for s in range(sweeps):
        for j in range(1, k + 1):
            rest = "".join(f" - {_cell(i, j)} * {current[i]}" for i in range(1, k + 1) if i != j)
            layers.append([f"r{j}{rest} AS g{s}_{j}"])
            layers.append([f"sign(g{s}_{j}) * greatest(abs(g{s}_{j}) - l1, 0) / (c{j}_{j} + l2) AS v{s}_{j}"])
            current[j] = f"v{s}_{j}"
    layers.append([f"{current[i]} AS b{i}" for i in range(1, k + 1)])
    bs, zs = ", ".join(f"b{i}" for i in range(1, k + 1)), " + ".join(f"b{i} * z{i}" for i in range(1, k + 1))
    centre = " - ".join(["ay", *[f"b{i} * a{i}" for i in range(1, k + 1)]])
    return f"""{_moments(name, rows, terms)},
{name}_mp AS MATERIALIZED (SELECT * FROM {name}_m, (VALUES {values}) AS v(model, point, ridge, l1, l2)),
{name}_mq AS MATERIALIZED (SELECT * FROM {name}_mp WHERE l1 = 0),
{name}_ml AS MATERIALIZED (SELECT * FROM {name}_mp WHERE l1 > 0),
{direct}, {_layered(f"{name}_l", f"{name}_ml", layers)},
{name}_b AS MATERIALIZED (SELECT grp, model, point, {bs}, {centre} AS b0 FROM {name}_q
  UNION ALL SELECT grp, model, point, {bs}, {centre} AS b0 FROM {name}_l),
{name} AS (SELECT z.grp, z.is_train, z.y, b.model, b.point, b0 + {zs} AS p FROM {name}_z z JOIN {name}_b b USING (grp))"""


def logistic(name: str, rows: str, k: int, penalty: float, rounds: int = 14) -> str:
    """Newton steps written out; ``{name}`` = rows with the probability of class 1."""
    parts = [
        f"{name}_t AS MATERIALIZED (SELECT *, 1.0::DOUBLE AS x0 FROM {rows})",
        f"{name}_0 AS MATERIALIZED (SELECT " + ", ".join(f"0.0::DOUBLE AS w{i}" for i in range(k + 1)) + ")",
    ]
    line = " + ".join(f"w{i} * x{i}" for i in range(k + 1))
    for t in range(rounds):
        hess = [
            f"sum(q * (1 - q) * x{i} * x{j})"
            + (f" + {penalty!r}" if i == j and i else "")
            + f" AS h{i}_{j}"
            for i in range(k + 1)
            for j in range(i + 1)
        ]
        grad = [
            f"sum((y - q) * x{i})" + (f" - {penalty!r} * max(w{i})" if i else "") + f" AS g{i}"
            for i in range(k + 1)
        ]
        olds = ", ".join(f"max(w{i}) AS o{i}" for i in range(k + 1))
        solve = _layered(
            f"{name}_s{t}",
            f"{name}_a{t}",
            _cholesky(
                k + 1, lambda i, j: f"h{max(i, j) - 1}_{min(i, j) - 1}", lambda i: f"g{i - 1}"
            ),
        )
        new = ", ".join(f"o{i} + b{i + 1} AS w{i}" for i in range(k + 1))
        parts.append(
            f"""{name}_a{t} AS MATERIALIZED (SELECT {', '.join(hess)}, {', '.join(grad)}, {olds} FROM
  (SELECT *, 1 / (1 + exp(-({line}))) AS q FROM {name}_t, {name}_{t} WHERE is_train)),
{solve},
{name}_{t + 1} AS MATERIALIZED (SELECT {new} FROM {name}_s{t})"""
        )
    parts.append(
        f"{name} AS MATERIALIZED (SELECT *, 1 / (1 + exp(-({line}))) AS score FROM {name}_t, {name}_{rounds})"
    )
    return ",\n".join(parts)


def regression_scores(rows: str, keys: str = "", where: str = "NOT is_train") -> str:
    """(keys..., n, R2, RMSE, MAE) rounded."""
    lead = f"{keys}, " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    return f"""SELECT {lead}count(*) AS n, round(1 - sum((y - p) ** 2) / (count(*) * var_pop(y)), 8) AS "R2",
    round(sqrt(avg((y - p) ** 2)), 4) AS "RMSE", round(avg(abs(y - p)), 4) AS "MAE"
    FROM {rows} WHERE {where}{group}"""


def label_scores(rows: str, keys: str = "model", auc: bool = True, where: str = "TRUE") -> str:
    """The six classification scores per key, class 1 positive; needs y, p and score."""
    def f1(c: int) -> str:
        return f"""coalesce(2.0 * count(*) FILTER (y = {c} AND p = {c})
          / nullif(count(*) FILTER (y = {c}) + count(*) FILTER (p = {c}), 0), 0)"""

    area = f"""LEFT JOIN (SELECT {keys}, round(sum(r) FILTER (y = 1) / (max(np) * max(nn)) - (max(np) + 1) / (2.0 * max(nn)), 8)
      AS "ROC_AUC" FROM (SELECT {keys}, y, (rank() OVER w + (count(*) OVER (PARTITION BY {keys}, score) - 1) / 2.0)::DOUBLE AS r,
      (count(*) FILTER (y = 1) OVER (PARTITION BY {keys}))::DOUBLE AS np,
      (count(*) FILTER (y = 0) OVER (PARTITION BY {keys}))::DOUBLE AS nn
      FROM {rows} WHERE {where} WINDOW w AS (PARTITION BY {keys} ORDER BY score)) GROUP BY {keys}) USING ({keys})"""
    return f"""SELECT * FROM (SELECT {keys}, count(*) AS n, round(avg((y = p)::INTEGER), 8) AS "Accuracy",
    round(coalesce(count(*) FILTER (y = 1 AND p = 1) / nullif(count(*) FILTER (p = 1), 0)::DOUBLE, 0), 8) AS "Precision_failure",
    round(coalesce(count(*) FILTER (y = 1 AND p = 1) / nullif(count(*) FILTER (y = 1), 0)::DOUBLE, 0), 8) AS "Recall_failure",
    round((({f1(0)}) * count(*) FILTER (y = 0) + ({f1(1)}) * count(*) FILTER (y = 1)) / count(*), 8)::DOUBLE AS "F1_weighted",
    round({f1(1)}, 8)::DOUBLE AS "F1_failure" FROM {rows} WHERE {where} GROUP BY {keys}) {area if auc else ''}"""
