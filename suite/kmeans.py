"""Seeded mini-batch k-means as SQL, step by step as ``lingmill.operators.clusters`` does it."""

from __future__ import annotations

from lingmill.operators.clusters import OVERSAMPLING, SEED_ROUNDS
from suite import fixtures as fx


def _gap(a: str, b: str) -> str:
    return f"pow(list_distance({a}, {b}), 2)"


def sql_kmeans(k: int, batches: int, seed: int = 0) -> str:
    """CTEs from ``r`` (key, grp, v) to ``centers`` (grp, label, center).

    They leave out what the test tables never need: more candidates for groups that
    draw fewer than k, and starved centres.
    """
    steps = [
        f"sizes AS MATERIALIZED (SELECT grp, least({batches}, count(*) // {k}) AS nb FROM r GROUP BY grp HAVING count(*) >= {k})",
        f"""dealt AS MATERIALIZED (SELECT key, grp, v, {fx.sql_draw('key', f'batch-{seed}', 1 << 32)} % nb AS batch
   FROM r JOIN sizes USING (grp))""",
        f"""b0 AS MATERIALIZED (SELECT key, grp, v FROM dealt WHERE batch = 0 OR grp IN (SELECT grp FROM dealt
   GROUP BY grp HAVING count(*) FILTER (WHERE batch = 0) < {k}))""",
        f"""c0 AS MATERIALIZED (SELECT key, grp, v FROM (SELECT *, row_number() OVER (PARTITION BY grp
   ORDER BY {fx.sql_hash('key', f'center-{seed}')}, key) AS place FROM b0) WHERE place = 1)""",
    ]
    for n in range(SEED_ROUNDS):
        steps += [
            f"""g{n} AS MATERIALIZED (SELECT x.key, x.grp, any_value(x.v) AS v, min({_gap('x.v', 'c.v')}) AS gap
   FROM b0 x JOIN c{n} c USING (grp) GROUP BY x.key, x.grp)""",
            f"""c{n + 1} AS MATERIALIZED (SELECT key, grp, v FROM c{n} UNION ALL
   SELECT key, grp, v FROM (SELECT *, sum(gap) OVER (PARTITION BY grp) / {OVERSAMPLING * k} AS unit FROM g{n})
   WHERE {fx.sql_uniform('key', f'round-{n}-{seed}')} * unit < gap)""",
        ]
    steps += [
        f"""near AS (SELECT x.grp, arg_min(c.key, {_gap('x.v', 'c.v')}) AS key
   FROM b0 x JOIN c{SEED_ROUNDS} c USING (grp) GROUP BY x.key, x.grp)""",
        "loads AS MATERIALIZED (SELECT key, count(*) AS n FROM near GROUP BY key)",
        f"""q0 AS MATERIALIZED (SELECT c.key, grp, v, n, -ln({fx.sql_uniform('c.key', f'wait-{seed}')}) AS wait, 1.0 AS gap
   FROM c{SEED_ROUNDS} c JOIN loads USING (key))""",
    ]
    for n in range(k):
        rate = "n" if n == 0 else "n * gap"
        held = f"CASE WHEN {n} = 0 THEN 1e300 ELSE gap END"
        steps += [
            f"p{n} AS MATERIALIZED (SELECT grp, {n} AS label, arg_min(v, wait / ({rate})) AS center FROM q{n} WHERE gap > 0 GROUP BY grp)",
            f"""q{n + 1} AS MATERIALIZED (SELECT key, grp, v, n, wait, least({held}, {_gap('v', 'center')}) AS gap
   FROM q{n} JOIN p{n} USING (grp))""",
        ]
    steps.append(f"m0 AS MATERIALIZED ({' UNION ALL '.join(f'SELECT grp, label, center, 0 AS weight FROM p{n}' for n in range(k))})")
    for n in range(batches):
        steps += [
            f"""a{n} AS MATERIALIZED (SELECT x.grp, arg_min(label, {_gap('x.v', 'm.center')}) AS label, any_value(x.v) AS v
   FROM dealt x JOIN m{n} m USING (grp) WHERE batch = {n} GROUP BY x.key, x.grp)""",
            f"""d{n} AS (SELECT grp, label, d, avg(x) AS x FROM (SELECT grp, label, unnest(v) AS x,
   generate_subscripts(v, 1) AS d FROM a{n}) GROUP BY ALL)""",
            f"""t{n} AS MATERIALIZED (SELECT grp, label, mean, n FROM (SELECT grp, label, list(x ORDER BY d) AS mean FROM d{n} GROUP BY ALL)
   JOIN (SELECT grp, label, count(*) AS n FROM a{n} GROUP BY ALL) USING (grp, label))""",
            f"""m{n + 1} AS MATERIALIZED (SELECT m.grp, m.label, weight + coalesce(n, 0) AS weight, CASE WHEN n IS NULL THEN center
   ELSE list_transform(list_zip(center, mean), lambda z: z[1] + (z[2] - z[1]) * (n / (weight + n))) END AS center
   FROM m{n} m LEFT JOIN t{n} t ON t.grp = m.grp AND t.label = m.label)""",
        ]
    return ",\n".join([*steps, f"centers AS (SELECT grp, label, center FROM m{batches})"])
