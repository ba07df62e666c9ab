"""SQL of fitted models: Newton's recursion step by step, over frames of the catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

STEPS = 9


def newton_steps(
    source: str,
    inputs: Sequence[str],
    label: str,
    weight: str,
    penalty: float = 1.0,
    name: str = "fitted_lr",
) -> dict[str, str]:
    """Common table expressions that end in ``name(beta)``, the intercept last.

    Sums of products over the rows of ``source``, then elimination on the list of their rows.
    """
    width = len(inputs) + 1
    ctes = {
        f"{name}_design": f"""select [{', '.join(f'({x})::double' for x in inputs)}, 1.0::double] as x,
            ({label})::double as y, ({weight})::double as w from {source}""",
        f"{name}_beta0": f"select list_transform(range({width}), lambda i: 0.0::double) as beta",
    }
    ridge = f"case when i = j and i < {width} then {penalty!r}::double else 0 end"
    for r in range(STEPS):
        ctes[f"{name}_margins{r}"] = f"""select x, w, y, beta, 1 / (1 + exp(-list_dot_product(x, beta))) as p
            from {name}_design, {name}_beta{r}"""
        ctes[f"{name}_sums{r}"] = f"""select i, j, sum(w * p * (1 - p) * x[i] * x[j]) + {ridge} as h,
            sum(w * (p - y) * x[i]) + case when i < {width} then {penalty!r}::double
            * any_value(beta)[i] else 0 end as g
            from {name}_margins{r}, (select unnest(generate_series(1, {width})) as i),
            (select unnest(generate_series(1, {width})) as j) group by i, j"""
        ctes[f"{name}_rows{r}"] = f"""select list(line order by i) as m from (select i,
            list_concat(list(h order by j), [max(g)]) as line from {name}_sums{r} group by i)"""
        ctes[f"{name}_solved{r}"] = f"""with recursive e(k, m) as (select 0, m from {name}_rows{r} union all
            select k + 1, list_transform(m, lambda line, i: case when i = k + 1
            then list_transform(line, lambda v: v / m[k + 1][k + 1])
            else list_transform(line, lambda v, j: v - line[k + 1] * m[k + 1][j] / m[k + 1][k + 1])
            end) from e where k < {width})
            select list_transform(m, lambda line: line[{width + 1}]) as step from e where k = {width}"""
        ctes[f"{name}_beta{r + 1}"] = f"""select list_transform(beta, lambda b, i: b - step[i]) as beta
            from {name}_beta{r}, {name}_solved{r}"""
    ctes[name] = f"select beta from {name}_beta{STEPS}"
    return ctes


def filled_inputs(
    source: str, train: str, numeric: Sequence[str], center: bool = True
) -> list[str]:
    """Numbers with the median of the training rows for missing ones, scaled by their deviation."""
    out = []
    for c in numeric:
        value = f"coalesce({c}, (select median({c}) from {train}))"
        mean = f"(select avg({value}) from {train})" if center else "0"
        scale = f"(select case when stddev_pop({value}) = 0 then 1 else stddev_pop({value}) end from {train})"
        out.append(f"({value} - {mean}) / {scale}")
    return out


def flag_inputs(train: str, categories: Mapping[str, Sequence[str]]) -> list[str]:
    """One 0/1 input per category; missing ones count as the most frequent category."""
    out = []
    for column, values in categories.items():
        mode = f"""(select {column} from {train} where {column} is not null
            group by 1 order by count(*) desc, 1 limit 1)"""
        out += [f"cast(coalesce({column}, {mode}) = '{v}' as integer)" for v in values]
    return out


def balanced(train: str) -> str:
    """The balanced class weight of a row of the training rows."""
    return f"""(select count(*) from {train}) / (2.0 * case when "default" = 1
        then (select count(*) from {train} where "default" = 1)
        else (select count(*) from {train} where "default" = 0) end)"""
