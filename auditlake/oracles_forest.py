"""DuckDB SQL that grows the isolation forest from the events and walks it.

Written from the definition in `ml/forest.py`: names, draws and cuts are MD5 digests, a level
of all trees is one CTE, and a recursive walk takes every event down every tree. The depth
below is that of trees of 256 rows, so a table must have at least 129 events.
"""

from __future__ import annotations

from auditlake.functions.lists import CONTAMINATION, FOREST_SAMPLE, FOREST_SEED, FOREST_TREES, ML_FEATURES
from auditlake.oracles import feature_ctes

DEPTH = 8


def _number(text: str, first: int | str = 1, digits: int = 13) -> str:
    """Some hexadecimal digits of a text's digest, as a whole number."""
    return f"CAST('0x' || substr(md5({text}), {first}, {digits}) AS BIGINT)"


def _sample(table: str) -> str:
    values = ", ".join(f"CASE WHEN isfinite(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) ELSE 0 END" for c in ML_FEATURES)
    once, eighth = f"'{FOREST_SEED}:' || name || ':' || copy", f"'{FOREST_SEED}:trees:' || (tree // 8) || ':' || name || ':' || copy"
    return f"""valued AS MATERIALIZED (SELECT event_id, row_number() OVER () AS rid, [{values}] AS v FROM {table}),
rates AS (SELECT psi, r, least(1::DOUBLE, {FOREST_TREES} * r) AS p FROM
  (SELECT psi, least(1::DOUBLE, 3::DOUBLE * psi / n) AS r FROM (SELECT count(*) AS n, least({FOREST_SAMPLE}, count(*)) AS psi FROM valued))),
named AS (SELECT v, md5(coalesce(event_id, '') || ':' || array_to_string(list_transform(v, lambda x:
  CAST(CAST(floor(least(greatest(x, -9e12::DOUBLE), 9e12::DOUBLE) * 1e6::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS VARCHAR)), ',')) AS name FROM valued),
numbered AS (SELECT v, name, row_number() OVER (PARTITION BY name) - 1 AS copy FROM named),
kept AS MATERIALIZED (SELECT * FROM numbered, rates WHERE {_number(once)} < ceil(p * pow(16::DOUBLE, 13))),
drawn AS (SELECT tree, v, psi, md5('{FOREST_SEED}:' || tree || ':' || name || ':' || copy) AS h, name, copy FROM kept, range({FOREST_TREES}) t(tree)
  WHERE {_number(eighth, '4 * (tree % 8) + 1', 4)} < ceil(r / p * 65536)),
sample AS MATERIALIZED (SELECT tree, v, row_number() OVER (PARTITION BY tree ORDER BY h, name, copy) AS sid FROM drawn QUALIFY sid <= psi),
long AS MATERIALIZED (SELECT tree, sid, j, v[j + 1] AS x FROM sample, range({len(ML_FEATURES)}) t(j)),
at0 AS (SELECT tree, sid, 1 AS node FROM sample)"""


def _level(d: int) -> str:
    place = f"'{FOREST_SEED}:' || tree || ':' || node || ':' ||"
    share = f"CAST({_number(place + ' ' + chr(39) + 'cut' + chr(39))} AS DOUBLE) / pow(16::DOUBLE, 13)"
    return f"""spread{d} AS (SELECT tree, node, j, min(x) AS lo, max(x) AS hi FROM at{d} JOIN long USING (tree, sid)
  GROUP BY tree, node, j HAVING min(x) < max(x)),
taken{d} AS (SELECT * FROM spread{d} QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY md5({place} j)) = 1),
cut{d} AS MATERIALIZED (SELECT tree, node, j, mark FROM (SELECT *, lo + {share} * (hi - lo) AS mark FROM taken{d}) WHERE mark < hi),
at{d + 1} AS MATERIALIZED (SELECT a.tree, a.sid, 2 * a.node + CASE WHEN l.x > c.mark THEN 1 ELSE 0 END AS node
  FROM at{d} a JOIN cut{d} c ON c.tree = a.tree AND c.node = a.node JOIN long l ON l.tree = a.tree AND l.sid = a.sid AND l.j = c.j)"""


def _nodes() -> str:
    rows = []
    for d in range(DEPTH + 1):
        cut = f"cut{d}" if d < DEPTH else "(SELECT 0 AS tree, 0 AS node, 0 AS j, 0.0::DOUBLE AS mark WHERE false)"
        rows.append(f"""SELECT m.tree, m.node, coalesce(c.j, -1) AS feature, coalesce(c.mark, 0.0::DOUBLE) AS threshold,
  CASE WHEN c.j IS NULL THEN -1 ELSE 2 * m.node END AS below, m.size, {d} AS depth
  FROM (SELECT tree, node, count(*) AS size FROM at{d} GROUP BY tree, node) m LEFT JOIN {cut} c ON c.tree = m.tree AND c.node = m.node""")
    return "nodes AS MATERIALIZED (" + "\nUNION ALL ".join(rows) + ")"


def _mean(n: str) -> str:
    """Mean path length of an unsuccessful search among n."""
    return (f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1::DOUBLE) + 0.5772156649015329::DOUBLE) - 2 * ({n} - 1::DOUBLE) / {n} "
            f"WHEN {n} = 2 THEN 1::DOUBLE ELSE 0::DOUBLE END")


def grown(table: str = "feat") -> str:
    return ",\n".join([_sample(table), *[_level(d) for d in range(DEPTH)], _nodes()])


def walked() -> str:
    """Score of every event: (event_id, s)."""
    return f"""walk(rid, tree, node) AS (
  SELECT rid, tree, 1 FROM valued, range({FOREST_TREES}) t(tree)
  UNION ALL
  SELECT w.rid, w.tree, n.below + CASE WHEN e.v[n.feature + 1] > n.threshold THEN 1 ELSE 0 END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.feature >= 0 JOIN valued e ON e.rid = w.rid),
leaves AS (SELECT tree, node, depth * 1000000000::BIGINT + CAST(round(({_mean('size')}) * 1e9::DOUBLE) AS BIGINT) AS length FROM nodes WHERE feature < 0),
ended AS (SELECT rid, CAST(sum(length) AS DOUBLE) / {FOREST_TREES}e9::DOUBLE AS mean FROM walk JOIN leaves USING (tree, node) GROUP BY rid),
unit AS (SELECT {_mean('psi')} AS norm FROM rates),
scores AS MATERIALIZED (SELECT event_id, -pow(2::DOUBLE, -mean / norm) AS s FROM valued JOIN ended USING (rid), unit)"""


def decided() -> str:
    """Flag, 0-100 score and severity of every event."""
    return f"""cutoff AS (SELECT quantile_cont(s, {CONTAMINATION}) AS off, min(s) AS least, max(s) AS most FROM scores),
offsets AS (SELECT event_id, s - off AS d, least - off AS dmin, most - off AS dmax FROM scores, cutoff),
graded AS (SELECT event_id, CASE WHEN d < 0 THEN 1 ELSE 0 END AS ml_anomaly_prediction,
  (1 - (d - dmin) / nullif(dmax - dmin, 0)) * 100 AS raw, round_even(raw, 2) AS ml_anomaly_score FROM offsets),
judged AS (SELECT *, CASE WHEN ml_anomaly_score >= 80 THEN 'critical' WHEN ml_anomaly_score >= 60 THEN 'high'
  WHEN ml_anomaly_score >= 40 THEN 'medium' ELSE 'low' END AS ml_severity FROM graded)"""


def oracle_sql() -> dict[str, str]:
    grow = f"WITH RECURSIVE {feature_ctes()},\n{grown()}"
    judge = f"{grow},\n{walked()},\n{decided()}\n"
    return {
        "ml_forest_nodes": f"""{grow}
SELECT CAST(tree AS INTEGER) AS tree_id, CAST(node AS INTEGER) AS node_id, CAST(feature AS INTEGER) AS feature, threshold,
  CAST(below AS INTEGER) AS "left", CAST(CASE WHEN below < 0 THEN -1 ELSE below + 1 END AS INTEGER) AS "right",
  CAST(size AS INTEGER) AS size, CAST(depth AS INTEGER) AS depth FROM nodes""",
        "model_roundtrip": f"{grow},\n{walked()}\nSELECT event_id, s AS score_samples FROM scores",
        "ml_predictions": f"{judge}SELECT event_id, ml_anomaly_prediction, ml_anomaly_score, ml_severity FROM judged",
        "sink_predictions": f"{judge}SELECT event_id, ml_anomaly_prediction, ml_severity FROM judged",
        "ml_forest_metrics": f"""{judge}, truth AS (SELECT ml_anomaly_prediction AS p, CASE WHEN is_anomaly_original THEN 1 ELSE 0 END AS y
  FROM judged JOIN feat USING (event_id)),
cells AS (SELECT count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 0) AS tn,
  count(*) FILTER (y = 0 AND p = 1) AS fp, count(*) FILTER (y = 1 AND p = 0) AS fn FROM truth)
SELECT round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 4) AS accuracy, round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 4) AS precision,
  round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 4) AS recall, round(coalesce(2::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1_score,
  tp AS true_positives, tn AS true_negatives, fp AS false_positives, fn AS false_negatives FROM cells""",
    }
