"""SQL twins of the named queries, for DuckDB over the same tables."""

from __future__ import annotations

from caremetrics.operators.models import POPULATION_SHARES
from caremetrics.plans.queries import (
    MEASURE,
    OTHER_MEASURE,
    REGION_POPULATION,
    REPORTED,
    REQUESTED,
    STATE,
    UNITS,
)
from caremetrics.sources.standins import PER_PERSON_STATES, STATES


def _mean(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / nullif(count({x}), 0)"


def _digits(x: str) -> str:
    return f"CAST(printf('%.6e', {x}) AS DOUBLE)"


def _list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


PANEL = "measurename, reportedmeasurename, state"
MEASURE_KEYS = "measurename, reportedmeasurename"
PANEL_ROW = "value, reportingstartdate, reportingunitcode, hospital_name, latitude, longitude"
PERIOD = "CAST((year({d}) - 1995) * 2 + CASE WHEN month({d}) > 6 THEN 1 ELSE 0 END AS INTEGER)"
LABEL = (
    "CAST(2011 + period AS VARCHAR) || '–' || lpad(CAST((2012 + period) % 100 AS VARCHAR), 2, '0')"
)

# Reference-shaped tables over the driver tables. Unused entries cost nothing.
BASE = f"""WITH RECURSIVE hospitals AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS name, 'Hospital' AS type,
    CASE WHEN s_suppkey % 20 = 0 THEN NULL ELSE CAST(-10 - s_suppkey % 34 AS DOUBLE) END AS latitude,
    CASE WHEN s_suppkey % 20 = 0 THEN NULL ELSE CAST(113 + s_suppkey % 40 AS DOUBLE) END AS longitude,
    CASE WHEN r_name = 'EUROPE' THEN 'Public' WHEN s_suppkey % 3 = 0 THEN 'Private' ELSE 'Public' END AS sector,
    CASE WHEN s_acctbal < 0 THEN 'Closed' ELSE 'Open' END AS open_closed,
    r_name AS state, n_name AS lhn, CAST(NULL AS VARCHAR) AS phn
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), mapped AS (
  SELECT * FROM hospitals WHERE latitude IS NOT NULL AND longitude IS NOT NULL
), datasets AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS reportingstartdate,
    o_orderstatus AS reportedmeasurecode, o_orderkey AS datasetid, o_orderpriority AS measurecode,
    o_orderpriority || ' / ' || o_orderstatus AS datasetname, (o_orderkey % 4 <> 0) AS stored
  FROM orders
), measurements AS (
  SELECT DISTINCT o_orderpriority AS measurecode, substr(o_orderpriority, 3) AS measurename FROM orders
), reported_measurements AS (
  SELECT DISTINCT o_orderstatus AS reportedmeasurecode,
    CASE o_orderstatus WHEN 'F' THEN 'Final' ELSE 'Open' END AS reportedmeasurename
  FROM orders WHERE o_orderstatus <> 'P'
), info AS (
  SELECT l_orderkey AS datasetid, CAST(l_suppkey AS VARCHAR) AS reportingunitcode,
    CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE min(l_extendedprice) END AS value,
    CASE WHEN l_orderkey % 10 = 0 THEN 'estimated' END AS caveats,
    CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR) AS id
  FROM lineitem GROUP BY l_orderkey, l_suppkey
  UNION ALL
  SELECT l_orderkey, 'NAT', max(l_extendedprice), NULL, CAST(l_orderkey AS VARCHAR) || '|NAT'
  FROM lineitem GROUP BY l_orderkey
), catalogue AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN '1995-1'
      ELSE strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') END AS reportingstartdate,
    o_orderstatus AS reportedmeasurecode,
    CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' END AS reportedmeasurename,
    o_orderpriority AS measurecode, substr(o_orderpriority, 3) AS measurename,
    o_orderkey AS datasetid, o_orderpriority || ' / ' || o_orderstatus AS datasetname
  FROM orders
), facts AS (
  SELECT m.measurename, r.reportedmeasurename, d.reportingstartdate, i.reportingunitcode, i.value
  FROM datasets d JOIN measurements m ON d.measurecode = m.measurecode
    JOIN reported_measurements r ON d.reportedmeasurecode = r.reportedmeasurecode
    JOIN info i ON d.datasetid = i.datasetid
  WHERE d.stored
), located AS (
  SELECT f.*, h.name AS hospital_name, h.state, h.latitude, h.longitude
  FROM facts f JOIN hospitals h ON f.reportingunitcode = h.code
), panels AS (
  SELECT * FROM located WHERE value IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
), series AS (
  SELECT {PANEL}, reportingstartdate, {_mean('value')} AS mean_value FROM panels
  GROUP BY {PANEL}, reportingstartdate
), national AS (
  SELECT {MEASURE_KEYS}, reportingstartdate, {_mean('value')} AS national_mean
  FROM facts WHERE reportingunitcode = 'NAT' GROUP BY {MEASURE_KEYS}, reportingstartdate
), periods AS (
  SELECT {PERIOD.format(d='o_orderdate')} AS period,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS n
  FROM orders GROUP BY 1
), state_periods AS (
  SELECT {PERIOD.format(d='o_orderdate')} AS period,
    list_extract([{_list(STATES)}], CAST(c_nationkey % 8 + 1 AS BIGINT)) AS state,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
), population AS (
  SELECT CAST(2011 + period AS INTEGER) AS year, CAST(n AS DOUBLE) AS total_population FROM periods
), info_states AS (
  SELECT {PERIOD.format(d='ds.reportingstartdate')} + 1 AS datasetid, h.state AS reportingunitcode,
    {_mean('i.value')} AS value
  FROM info i JOIN datasets ds ON i.datasetid = ds.datasetid JOIN hospitals h ON i.reportingunitcode = h.code
  GROUP BY 1, 2
  UNION ALL
  SELECT {PERIOD.format(d='ds.reportingstartdate')} + 1, 'NAT', {_mean('i.value')}
  FROM info i JOIN datasets ds ON i.datasetid = ds.datasetid
  WHERE i.reportingunitcode = 'NAT' GROUP BY 1
)"""


def _sql(body: str, *ctes: str) -> str:
    return "".join([BASE, *[f", {c.strip()}" for c in ctes], "\n", body.strip()])


def _state_columns(labels: list[str], names: list[str], cast: str | None = None) -> str:
    parts = []
    for label, name in zip(labels, names):
        cell = f"max(CASE WHEN s.state = '{label}' THEN s.total END)"
        text = f"CAST({cell} AS {cast})" if cast else f"CAST({cell} AS VARCHAR)"
        if label == "NT" and cast is None:
            text = f"CASE WHEN p.period % 5 = 0 THEN 'n.p.' ELSE {text} END"
        parts.append(f'{text} AS "{name}"')
    return ", ".join(parts)


_BUDGET_LABELS = ["NSW", "Vic", "Qld", "WA", "SA", "Tas", "NT"]
_BUDGET = f"""budget AS (
  SELECT CAST(2011 + p.period AS INTEGER) AS year, CAST(any_value(p.total) AS DOUBLE) AS "NAT",
    {_state_columns(PER_PERSON_STATES, _BUDGET_LABELS, 'DOUBLE')}
  FROM periods p LEFT JOIN state_periods s ON p.period = s.period
  WHERE p.period >= 0 GROUP BY p.period
)"""
_BUDGET_COLUMNS = ", ".join(f'"{c}"' for c in sorted([*_BUDGET_LABELS, "NAT"]))

_TRAINING = """training AS (
  SELECT p.year, b."NAT" AS nat, p.total_population FROM budget b JOIN population p ON b.year = p.year
)"""
_LINE = """line AS (
  SELECT regr_slope(nat, total_population) AS slope, regr_intercept(nat, total_population) AS intercept
  FROM training
)"""

_TARGETS = f"""targets AS (
  SELECT CAST(2010 + row_number() OVER (ORDER BY datasetid) AS INTEGER) AS year,
    {", ".join(f'''max(CASE WHEN reportingunitcode = '{u}' THEN value END) AS "{u}_values"''' for u in UNITS)}
  FROM info_states
  WHERE reportingunitcode IN ({_list(UNITS)})
    AND datasetid < (SELECT max(datasetid) FROM info_states WHERE reportingunitcode IN ({_list(UNITS)}))
  GROUP BY datasetid
)"""

_PRICES = f"""prices AS (
  SELECT {LABEL} AS year, CAST(total AS DOUBLE) AS current_price,
    CAST(total * 2 AS DOUBLE) AS constant_price,
    CASE WHEN period = 0 THEN NULL ELSE CAST(n * 2 AS DOUBLE) END AS nominal_change,
    CASE WHEN period % 3 = 0 THEN NULL ELSE CAST(n AS DOUBLE) END AS real_growth
  FROM periods WHERE period >= 0
)"""

_DENSITY_ROWS = ", ".join(f"('{s}', CAST({n} AS BIGINT))" for s, n in REGION_POPULATION.items())
_REQUESTED_ROWS = ", ".join(f"({_list(list(r))})" for r in REQUESTED)

_DECOMPOSE = (
    f"""counted AS (
  SELECT *, count(*) OVER (PARTITION BY {PANEL}) AS cnt,
    row_number() OVER (PARTITION BY {PANEL} ORDER BY reportingstartdate) AS rn FROM series
)""",
    f"""trended AS (
  SELECT *, (sum(mean_value) OVER (PARTITION BY {PANEL} ORDER BY reportingstartdate
        ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)
    - 0.5 * (lag(mean_value, 6) OVER (PARTITION BY {PANEL} ORDER BY reportingstartdate)
           + lead(mean_value, 6) OVER (PARTITION BY {PANEL} ORDER BY reportingstartdate))) / 12 AS t
  FROM counted WHERE cnt >= 24
)""",
    f"""phases AS (
  SELECT {PANEL}, (rn - 1) % 12 AS ph, avg(mean_value - t) AS pm FROM trended GROUP BY ALL
)""",
    f"""centred AS (
  SELECT {PANEL}, ph, pm - avg(pm) OVER (PARTITION BY {PANEL}) AS s FROM phases
)""",
)

_HOLT = (
    f"""obs AS (
  SELECT *, row_number() OVER (PARTITION BY {PANEL} ORDER BY reportingstartdate) AS rn,
    count(*) OVER (PARTITION BY {PANEL}) AS cnt,
    max(reportingstartdate) OVER (PARTITION BY {PANEL}) AS last_date FROM series
)""",
    """grid AS (
  SELECT CAST(a.i AS DOUBLE) / 10 AS alpha, CAST(b.i AS DOUBLE) / 10 AS beta
  FROM range(1, 10) a(i), range(1, 10) b(i)
)""",
    f"""run AS (
  SELECT s2.measurename, s2.reportedmeasurename, s2.state, g.alpha, g.beta, CAST(2 AS BIGINT) AS rn,
    s2.mean_value AS lv, s2.mean_value - s1.mean_value AS tr, CAST(0 AS DOUBLE) AS sse
  FROM obs s2 JOIN obs s1 USING ({PANEL}) CROSS JOIN grid g
  WHERE s1.rn = 1 AND s2.rn = 2 AND s1.cnt >= 12
  UNION ALL
  SELECT r.measurename, r.reportedmeasurename, r.state, r.alpha, r.beta, r.rn + 1,
    (r.lv + r.tr) + r.alpha * (o.mean_value - (r.lv + r.tr)),
    r.tr + r.alpha * r.beta * (o.mean_value - (r.lv + r.tr)),
    r.sse + (o.mean_value - (r.lv + r.tr)) * (o.mean_value - (r.lv + r.tr))
  FROM run r JOIN obs o ON r.measurename = o.measurename
    AND r.reportedmeasurename = o.reportedmeasurename AND r.state = o.state AND o.rn = r.rn + 1
)""",
    f"""best AS (
  SELECT r.*, o.last_date FROM run r JOIN obs o USING ({PANEL})
  WHERE o.rn = o.cnt AND r.rn = o.cnt
  QUALIFY row_number() OVER (PARTITION BY {PANEL} ORDER BY r.sse, r.alpha, r.beta) = 1
)""",
)

_IS_TRAIN = "substr(md5({key}), 1, 8) < 'cccccccc'"
_TRAIN_LINES = f"""lines AS (
  SELECT l_quantity AS x1, l_discount AS x2, l_tax AS x3, l_extendedprice AS y1,
    l_extendedprice * (1 - l_discount) AS y2
  FROM lineitem
  WHERE {_IS_TRAIN.format(key="CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)")}
)"""
_MOMENTS = """moments AS (
  SELECT target, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(y) AS my,
    var_pop(x1) AS a11, covar_pop(x1, x2) AS a12, covar_pop(x1, x3) AS a13,
    var_pop(x2) AS a22, covar_pop(x2, x3) AS a23, var_pop(x3) AS a33,
    covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2, covar_pop(x3, y) AS c3
  FROM (SELECT 'l_extendedprice' AS target, x1, x2, x3, y1 AS y FROM lines
        UNION ALL SELECT 'net_price', x1, x2, x3, y2 FROM lines)
  GROUP BY target
)"""
# Normal equations of three features, by Cramer's rule.
_SOLVED = """solved AS (
  SELECT *,
    (c1 * (a22 * a33 - a23 * a23) - a12 * (c2 * a33 - a23 * c3) + a13 * (c2 * a23 - a22 * c3)) / det AS b1,
    (a11 * (c2 * a33 - a23 * c3) - c1 * (a12 * a33 - a23 * a13) + a13 * (a12 * c3 - c2 * a13)) / det AS b2,
    (a11 * (a22 * c3 - c2 * a23) - a12 * (a12 * c3 - c2 * a13) + c1 * (a12 * a23 - a22 * a13)) / det AS b3
  FROM (SELECT *, a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13)
          + a13 * (a12 * a23 - a22 * a13) AS det FROM moments)
)"""

# Elastic net (strength 0.1, mix 0.8) on features scaled to unit deviation: the
# penalty acts on the scaled problem, solved by cyclic coordinate descent.
_NET_LINES = """scaled_lines AS (
  SELECT (x1 - avg(x1) OVER ()) / stddev_samp(x1) OVER () AS x1,
    (x2 - avg(x2) OVER ()) / stddev_samp(x2) OVER () AS x2,
    (x3 - avg(x3) OVER ()) / stddev_samp(x3) OVER () AS x3, y1, y2
  FROM lines
)"""
_NET_MOMENTS = _MOMENTS.replace("moments AS", "net_moments AS").replace("FROM lines", "FROM scaled_lines").replace(
    "covar_pop(x3, y) AS c3", "covar_pop(x3, y) AS c3, stddev_pop(y) AS sy"
)
_NET_SCALED = """net AS (
  SELECT target, my, m1, m2, m3, sy, sqrt(a11) AS s1, sqrt(a22) AS s2, sqrt(a33) AS s3,
    a12 / sqrt(a11 * a22) AS r12, a13 / sqrt(a11 * a33) AS r13, a23 / sqrt(a22 * a33) AS r23,
    c1 / sqrt(a11) / sy AS g1, c2 / sqrt(a22) / sy AS g2, c3 / sqrt(a33) / sy AS g3,
    CAST(0.08 AS DOUBLE) / sy AS l1, CAST(0.02 AS DOUBLE) / sy AS l2
  FROM net_moments
)"""


def _shrunk(x: str) -> str:
    return f"sign({x}) * greatest(abs({x}) - l1, 0) / (1 + l2)"


_NET_STEPS = f"""net_steps AS (
  SELECT *, 0 AS step, CAST(0 AS DOUBLE) AS w1, CAST(0 AS DOUBLE) AS w2, CAST(0 AS DOUBLE) AS w3 FROM net
  UNION ALL
  SELECT * EXCLUDE (w1, w2, w3, v1, v2), v1, v2, {_shrunk('(g3 - r13 * v1 - r23 * v2)')} FROM (
    SELECT *, {_shrunk('(g2 - r12 * v1 - r23 * w3)')} AS v2 FROM (
      SELECT * REPLACE (step + 1 AS step), {_shrunk('(g1 - r12 * w2 - r13 * w3)')} AS v1
      FROM net_steps WHERE step < 100))
)"""
_NET_SOLVED = """net_solved AS (
  SELECT target, my, m1, m2, m3, w1 * sy / s1 AS b1, w2 * sy / s2 AS b2, w3 * sy / s3 AS b3
  FROM net_steps WHERE step = 100
)"""

_NAMED = f"""named AS (SELECT year, {", ".join(f'"{c}" AS "x_{c}"' for c in sorted([*_BUDGET_LABELS, "NAT"]))}
  FROM budget WHERE COLUMNS(*) IS NOT NULL)"""
# Two features per target of the design table.
_DESIGN_SOLVED = f"""design_solved AS (
  SELECT target, my, m1, m2, (c1 * a22 - c2 * a12) / (a11 * a22 - a12 * a12) AS b1,
    (c2 * a11 - c1 * a12) / (a11 * a22 - a12 * a12) AS b2
  FROM (SELECT target, avg(y) AS my, avg("x_NAT") AS m1, avg("x_NSW") AS m2, var_pop("x_NAT") AS a11,
          covar_pop("x_NAT", "x_NSW") AS a12, var_pop("x_NSW") AS a22,
          covar_pop("x_NAT", y) AS c1, covar_pop("x_NSW", y) AS c2
        FROM ({" UNION ALL ".join(
            f"""SELECT '{u}_values' AS target, t."{u}_values" AS y, b."x_NAT", b."x_NSW"
                FROM named b JOIN targets t ON b.year = t.year WHERE t."{u}_values" IS NOT NULL"""
            for u in UNITS)})
        GROUP BY target)
)"""
_TEST_LINES = (
    _TRAIN_LINES.replace("lines AS", "test_lines AS").replace("WHERE ", "WHERE NOT ")
    + """, tested AS (
  SELECT 'l_extendedprice' AS target, x1, x2, x3, y1 AS y FROM test_lines
  UNION ALL SELECT 'net_price', x1, x2, x3, y2 FROM test_lines
)"""
)

_ITEM_COLUMNS = "datasetid, reportingunitcode, value, caveats, id"

_RANKING = f"""SELECT *, rank() OVER (PARTITION BY {PANEL} ORDER BY mean_value DESC) AS rank FROM (
  SELECT {PANEL}, hospital_name, {_mean('value')} AS mean_value
  FROM panels GROUP BY {PANEL}, hospital_name)"""


def oracle() -> dict[str, str]:
    panel_where = (
        f"measurename = '{MEASURE}' AND reportedmeasurename = '{REPORTED}' AND state = '{STATE}'"
    )
    scaled = ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}_scaled"
        for c in ("l_quantity", "l_discount", "l_tax")
    )
    return {
        "scan_catalogue": _sql("SELECT * FROM catalogue"),
        "scan_items": _sql("SELECT datasetid, reportingunitcode, value, caveats FROM info"),
        "scan_hospitals": _sql("SELECT * FROM hospitals"),
        "item_ids": _sql(f"SELECT {_ITEM_COLUMNS} FROM info"),
        "catalogue_datasets": _sql(
            """SELECT TRY_CAST(reportingstartdate AS DATE) AS reportingstartdate, reportedmeasurecode,
                 datasetid, measurecode, datasetname, FALSE AS stored FROM catalogue"""
        ),
        "dim_measures": _sql(
            "SELECT measurecode, min(measurename) AS measurename FROM catalogue GROUP BY measurecode"
        ),
        "dim_reported_measures": _sql(
            """SELECT reportedmeasurecode, min(reportedmeasurename) AS reportedmeasurename
               FROM catalogue GROUP BY reportedmeasurecode"""
        ),
        "upsert_new_rows": _sql(
            f"""SELECT {_ITEM_COLUMNS} FROM info
                WHERE datasetid NOT IN (SELECT datasetid FROM datasets WHERE stored)"""
        ),
        "mark_stored": _sql(
            """SELECT reportingstartdate, reportedmeasurecode, datasetid, measurecode, datasetname,
                 stored OR datasetid IN (SELECT datasetid FROM info) AS stored FROM datasets"""
        ),
        "pending_datasets": _sql("SELECT datasetid FROM datasets WHERE NOT stored"),
        "dataset_batches": _sql(
            """SELECT datasetid, (row_number() OVER (ORDER BY datasetid) - 1) // 20 AS batch_id
               FROM datasets WHERE NOT stored"""
        ),
        "append_twice": _sql(f"SELECT {_ITEM_COLUMNS} FROM info"),
        "daily_ingest": _sql(
            """SELECT TRY_CAST(reportingstartdate AS DATE) AS reportingstartdate, reportedmeasurecode,
                 datasetid, measurecode, datasetname, datasetid IN (SELECT datasetid FROM info) AS stored
               FROM catalogue"""
        ),
        "stream_items_upsert": _sql(f"SELECT {_ITEM_COLUMNS} FROM info"),
        "stream_mark_stored": _sql(
            """SELECT datasetid, stored OR datasetid IN (SELECT datasetid FROM info) AS stored
               FROM datasets"""
        ),
        "rejected_items": _sql(
            """SELECT 'value' AS reason, datasetid || ',NAT,n/a,' AS record FROM info
               WHERE reportingunitcode = 'NAT' AND datasetid % 7 = 0
               UNION ALL
               SELECT 'dataset id', 'D' || datasetid || ',NAT,,' FROM info
               WHERE reportingunitcode = 'NAT' AND datasetid % 7 = 0
               UNION ALL
               SELECT 'header', datasetid || ',NAT,1,' FROM info
               WHERE reportingunitcode = 'NAT' AND datasetid % 7 = 0"""
        ),
        "pending_after_rejects": _sql(
            """SELECT datasetid, stored OR (datasetid % 7 <> 0 AND datasetid IN (SELECT datasetid FROM info)) AS stored
               FROM datasets"""
        ),
        "cube_after_appends": _sql(
            """SELECT measurecode, reportedmeasurecode, reportingunitcode, reportingstartdate,
                 CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(value) AS n
               FROM info JOIN datasets USING (datasetid) WHERE stored AND value IS NOT NULL
               GROUP BY measurecode, reportedmeasurecode, reportingunitcode, reportingstartdate"""
        ),
        "series_from_cube": _sql("SELECT * FROM series"),
        "ranking_from_cube": _sql(_RANKING),
        "storage_overview": _sql(
            """SELECT total, stored, pct, printf('%.2f%%', pct * 100) AS pct_text FROM (
                 SELECT count(*) AS total, count(*) FILTER (stored) AS stored,
                   CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (stored) AS DOUBLE) / count(*)
                     ELSE 0 END AS pct
                 FROM datasets)"""
        ),
        "catalogue_enriched": _sql(
            """SELECT ds.*, m.measurename, rm.reportedmeasurename FROM datasets ds
               LEFT JOIN measurements m ON ds.measurecode = m.measurecode
               LEFT JOIN reported_measurements rm ON ds.reportedmeasurecode = rm.reportedmeasurecode
               WHERE ds.stored"""
        ),
        "measure_options": _sql(
            """SELECT DISTINCT m.measurename FROM datasets ds
               JOIN measurements m ON ds.measurecode = m.measurecode WHERE ds.stored ORDER BY 1"""
        ),
        "reported_measure_options": _sql(
            f"""SELECT DISTINCT rm.reportedmeasurename FROM datasets ds
                JOIN measurements m ON ds.measurecode = m.measurecode
                JOIN reported_measurements rm ON ds.reportedmeasurecode = rm.reportedmeasurecode
                WHERE ds.stored AND m.measurename = '{MEASURE}' ORDER BY 1"""
        ),
        "open_states": _sql(
            "SELECT DISTINCT state FROM hospitals WHERE open_closed = 'Open' ORDER BY 1"
        ),
        "hospital_states": _sql("SELECT DISTINCT state FROM mapped ORDER BY 1"),
        "hospital_statuses": _sql("SELECT DISTINCT open_closed FROM mapped ORDER BY 1"),
        "measure_panel": _sql(
            f"SELECT {PANEL_ROW} FROM panels WHERE {panel_where} ORDER BY reportingstartdate"
        ),
        "panel_with_fallback": _sql(
            f"""SELECT {PANEL}, {PANEL_ROW}, FALSE AS is_national
                FROM panels JOIN requested USING ({PANEL})
                UNION ALL
                SELECT f.measurename, f.reportedmeasurename, q.state, f.value, f.reportingstartdate,
                  f.reportingunitcode, NULL, NULL, NULL, TRUE
                FROM facts f JOIN requested q ON f.measurename = q.measurename
                  AND f.reportedmeasurename = q.reportedmeasurename
                WHERE f.reportingunitcode = 'NAT' AND f.value IS NOT NULL
                  AND NOT EXISTS (SELECT 1 FROM located l WHERE l.measurename = q.measurename
                    AND l.reportedmeasurename = q.reportedmeasurename AND l.state = q.state)""",
            f"requested({PANEL}) AS (VALUES {_REQUESTED_ROWS})",
        ),
        "measure_series": _sql("SELECT * FROM series"),
        "national_average": _sql("SELECT * FROM national"),
        "series_vs_national": _sql(
            f"""SELECT s.*, n.national_mean FROM series s LEFT JOIN national n
                USING ({MEASURE_KEYS}, reportingstartdate)"""
        ),
        "measure_pair": _sql(
            f"""SELECT a.state, a.reportedmeasurename, a.reportingstartdate,
                  a.mean_value AS value_a, b.value_b
                FROM series a JOIN (
                  SELECT state, reportingstartdate, {_mean('value')} AS value_b FROM located
                  WHERE measurename = '{OTHER_MEASURE}' GROUP BY state, reportingstartdate) b
                ON a.state = b.state AND a.reportingstartdate = b.reportingstartdate
                WHERE a.measurename = '{MEASURE}'"""
        ),
        "hospital_ranking": _sql(_RANKING),
        "value_histogram": _sql(
            f"""SELECT {PANEL}, CAST(bins.b AS INTEGER) AS bin, l.lo + bins.b * l.w AS lo,
                  CASE WHEN bins.b = 19 THEN l.hi ELSE l.lo + (bins.b + 1) * l.w END AS hi,
                  coalesce(c.n, 0) AS n
                FROM limits l CROSS JOIN range(20) bins(b) LEFT JOIN (
                  SELECT {PANEL}, CASE WHEN w > 0 THEN least(CAST(floor((value - lo) / w) AS BIGINT), 19)
                    ELSE 0 END AS b, count(*) AS n
                  FROM panels JOIN limits USING ({PANEL}) GROUP BY ALL) c USING ({PANEL}, b)""",
            f"""limits AS (SELECT {PANEL}, min(value) AS lo, max(value) AS hi,
                  (max(value) - min(value)) / 20 AS w FROM panels GROUP BY {PANEL})""",
        ),
        "box_stats": _sql(
            f"""SELECT {PANEL}, hospital_name, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
                  min(value) FILTER (fine) AS lo_whisker, max(value) FILTER (fine) AS hi_whisker,
                  count(*) FILTER (NOT fine) AS outliers
                FROM (SELECT p.{PANEL.replace(', ', ', p.')}, p.hospital_name, p.value, q.q1, q.median, q.q3,
                    p.value BETWEEN q.q1 - (q.q3 - q.q1) * CAST(1.5 AS DOUBLE)
                      AND q.q3 + (q.q3 - q.q1) * CAST(1.5 AS DOUBLE) AS fine
                  FROM panels p JOIN quartiles q USING ({PANEL}, hospital_name)) AS b
                GROUP BY {PANEL}, hospital_name, b.q1, b.median, b.q3""",
            f"""quartiles AS (SELECT {PANEL}, hospital_name,
                  quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3
                FROM panels GROUP BY {PANEL}, hospital_name)""",
        ),
        "hospital_date_heatmap": _sql(
            f"""SELECT {PANEL}, hospital_name, reportingstartdate,
                  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
                FROM panels GROUP BY {PANEL}, hospital_name, reportingstartdate"""
        ),
        "hospital_points": _sql("SELECT name, latitude, longitude FROM mapped"),
        "state_sector_counts": _sql(
            "SELECT state, sector, count(*) AS n FROM mapped GROUP BY state, sector"
        ),
        "sector_by_state": _sql(
            """SELECT state, count(*) FILTER (sector = 'Private') AS n_private,
                 count(*) FILTER (sector = 'Public') AS n_public FROM mapped
               WHERE sector IN ('Private', 'Public') GROUP BY state"""
        ),
        "hospitals_by_state_status": _sql(
            f"SELECT * FROM mapped WHERE state = '{STATE}' AND open_closed = 'Open'"
        ),
        "sector_share": _sql(
            f"""SELECT sector, count(*) AS n FROM mapped
                WHERE state = '{STATE}' AND open_closed = 'Open' GROUP BY sector ORDER BY n DESC, sector"""
        ),
        "hospital_density": _sql(
            """SELECT state, n, population, CAST(n AS DOUBLE) / population * 1000 AS per_1000,
                 coalesce(format('{:,}', population), 'N/A') AS population_text,
                 coalesce(printf('%.2f', CAST(n AS DOUBLE) / population * 1000), 'N/A') AS per_1000_text
               FROM (SELECT state, count(*) FILTER (open_closed = 'Open') AS n FROM mapped GROUP BY state)
               LEFT JOIN people USING (state)""",
            f"people(state, population) AS (VALUES {_DENSITY_ROWS})",
        ),
        "sheet_tidy": _sql(
            f"""SELECT CAST(2 + p.period AS INTEGER) AS row_no, {LABEL.replace('period', 'p.period')} AS year,
                  {_state_columns(STATES, STATES)}, CAST(any_value(p.total) AS VARCHAR) AS "Australia"
                FROM periods p LEFT JOIN state_periods s ON p.period = s.period
                WHERE p.period >= 0 GROUP BY p.period"""
        ),
        "length_of_stay_long": _sql(
            f"""SELECT block, hospital_type, {LABEL} AS year, days
                FROM (SELECT * FROM (SELECT DISTINCT period FROM stays) AS years(period),
                    (VALUES ('Public'), ('Private')) AS blocks(block),
                    (VALUES ('Acute'), ('Subacute'), ('Other')) AS kinds(hospital_type))
                LEFT JOIN stays USING (period, block, hospital_type)""",
            f"""stays AS (
                SELECT CASE l_linestatus WHEN 'O' THEN 'Public' ELSE 'Private' END AS block,
                  CASE l_returnflag WHEN 'A' THEN 'Acute' WHEN 'N' THEN 'Subacute' ELSE 'Other' END
                    AS hospital_type,
                  {PERIOD.format(d='l_shipdate')} AS period,
                  CAST(CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) * 100 // count(*) AS DOUBLE) / 100 AS days
                FROM lineitem GROUP BY ALL)""",
        ),
        "spend_prices": _sql("SELECT * FROM prices", _PRICES),
        "spend_prices_long": _sql(
            " UNION ALL ".join(
                f"SELECT year, '{c}' AS type, {c} AS value FROM prices"
                for c in ("current_price", "constant_price", "nominal_change", "real_growth")
            ),
            _PRICES,
        ),
        "spend_by_state": _sql(
            f"""SELECT {LABEL} AS year, state,
                  CASE WHEN state = 'NT' AND period % 5 = 0 THEN NULL ELSE CAST(total AS DOUBLE) END AS amount
                FROM state_periods WHERE period >= 0
                UNION ALL SELECT {LABEL}, 'Australia', CAST(total AS DOUBLE)
                FROM periods WHERE period >= 0"""
        ),
        "gdp_ratio": _sql(
            """SELECT CAST(2011 + period AS INTEGER) AS year, CAST(total AS DOUBLE) AS gdp,
                 CASE WHEN period % 4 = 0 THEN NULL ELSE CAST(n AS DOUBLE) END AS ratio
               FROM periods WHERE period >= 0"""
        ),
        "budget_table": _sql(
            " UNION ALL ".join(
                f"""SELECT year, '{c}' AS state, "{c}" AS per_capita FROM budget"""
                for c in [*_BUDGET_LABELS, "NAT"]
            ),
            _BUDGET,
        ),
        "seasonal_decompose": _sql(
            f"""SELECT {PANEL}, reportingstartdate, mean_value, floor(round(t, 9) * 10000 + 0.5::DOUBLE) / 10000 AS trend,
                  floor(round(s, 9) * 10000 + 0.5::DOUBLE) / 10000 AS seasonal,
                  floor(round(mean_value - t - s, 9) * 10000 + 0.5::DOUBLE) / 10000 AS resid
                FROM trended JOIN centred USING ({PANEL})
                WHERE (rn - 1) % 12 = ph""",
            *_DECOMPOSE,
        ),
        "holt_forecast": _sql(
            f"""SELECT {PANEL}, CAST(k AS INTEGER) AS step,
                  last_day(CAST(last_date + to_months(CAST(k - 1 AS INTEGER)) AS DATE)) AS date,
                  alpha, beta, floor(round(lv + k * tr, 8) * 10000 + 0.5::DOUBLE) / 10000 AS forecast
                FROM best CROSS JOIN range(1, 13) steps(k)""",
            *_HOLT,
        ),
        "population_shares": _sql(
            " UNION ALL ".join(
                f"""SELECT year, '{s}' AS state, total_population * CAST({p} AS DOUBLE) AS population
                    FROM population"""
                for s, p in POPULATION_SHARES.items()
            )
        ),
        "budget_population": _sql("SELECT * FROM training", _BUDGET, _TRAINING),
        "budget_regression": _sql(
            "SELECT round(slope, 4) AS slope, round(intercept, 2) AS intercept FROM line",
            _BUDGET,
            _TRAINING,
            _LINE,
        ),
        "predict_scenarios": _sql(
            """SELECT CAST(2025 + i AS INTEGER) AS year, scenario, round(slope * pop + intercept, 2) AS prediction
               FROM (SELECT i, 'high' AS scenario, CAST(base * (110 + 10 * i) // 100 AS DOUBLE) AS pop FROM future
                     UNION ALL SELECT i, 'medium', CAST(base * (105 + 5 * i) // 100 AS DOUBLE) FROM future
                     UNION ALL SELECT i, 'low', CAST(base * (100 + i) // 100 AS DOUBLE) FROM future)
               CROSS JOIN line""",
            _BUDGET,
            _TRAINING,
            _LINE,
            """future AS (SELECT i, base FROM (SELECT CAST(sum(n) AS BIGINT) // 14 AS base FROM periods)
                 CROSS JOIN range(5) t(i))""",
        ),
        "wide_targets": _sql("SELECT * FROM targets", _TARGETS),
        "lm_design": _sql(
            " UNION ALL ".join(
                f"""SELECT t.year, '{u}_values' AS target, t."{u}_values" AS y, b.* EXCLUDE (year)
                    FROM named b JOIN targets t ON b.year = t.year WHERE t."{u}_values" IS NOT NULL"""
                for u in UNITS
            ),
            _BUDGET,
            _TARGETS,
            _NAMED,
        ),
        "lm_targets": _sql(
            f"""SELECT target, 'x_NAT' AS feature, {_digits('b1')} AS coefficient FROM design_solved
               UNION ALL SELECT target, 'x_NSW', {_digits('b2')} FROM design_solved
               UNION ALL SELECT target, '(intercept)', {_digits('my - b1 * m1 - b2 * m2')} FROM design_solved""",
            _BUDGET,
            _TARGETS,
            _NAMED,
            _DESIGN_SOLVED,
        ),
        "heldout_error": _sql(
            f"""SELECT target, count(*) AS n, {_digits('sqrt(avg(miss * miss))')} AS rmse,
                 {_digits('avg(abs(miss))')} AS mae, {_digits('1 - avg(miss * miss) / var_pop(y)')} AS r2
               FROM (SELECT t.*, t.y - (s.my - s.b1 * s.m1 - s.b2 * s.m2 - s.b3 * s.m3)
                       - s.b1 * t.x1 - s.b2 * t.x2 - s.b3 * t.x3 AS miss
                     FROM tested t JOIN solved s USING (target)) GROUP BY target""",
            _TRAIN_LINES,
            _MOMENTS,
            _SOLVED,
            _TEST_LINES,
        ),
        "train_test_split": _sql(
            f"SELECT datasetid, {_IS_TRAIN.format(key='CAST(datasetid AS VARCHAR)')} AS is_train FROM datasets"
        ),
        "standardize": _sql(f"SELECT l_orderkey, l_linenumber, {scaled} FROM lineitem"),
        "lm_multi": _sql(
            f"""SELECT target, 'l_quantity' AS feature, {_digits('b1')} AS coefficient FROM solved
               UNION ALL SELECT target, 'l_discount', {_digits('b2')} FROM solved
               UNION ALL SELECT target, 'l_tax', {_digits('b3')} FROM solved
               UNION ALL SELECT target, '(intercept)', {_digits('my - b1 * m1 - b2 * m2 - b3 * m3')} FROM solved""",
            _TRAIN_LINES,
            _MOMENTS,
            _SOLVED,
        ),
        "lm_elastic_net": _sql(
            f"""SELECT target, 'l_quantity_scaled' AS feature, {_digits('b1')} AS coefficient FROM net_solved
               UNION ALL SELECT target, 'l_discount_scaled', {_digits('b2')} FROM net_solved
               UNION ALL SELECT target, 'l_tax_scaled', {_digits('b3')} FROM net_solved
               UNION ALL SELECT target, '(intercept)', {_digits('my - b1 * m1 - b2 * m2 - b3 * m3')}
               FROM net_solved""",
            _TRAIN_LINES,
            _NET_LINES,
            _NET_MOMENTS,
            _NET_SCALED,
            _NET_STEPS,
            _NET_SOLVED,
        ),
    }
