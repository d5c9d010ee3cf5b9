"""DuckDB SQL for every registered query, over the same parquet tables.

Written independently of the Spark code: plain joins, window functions and
a recursive CTE for k-means, on un-merged vectors where a weight would
otherwise be needed (medians).  The language list and parameters come from
``params`` so both sides use one copy.

DuckDB notes: ``//`` on integers truncates toward zero like Spark's ``div``,
but a cast from double to int rounds, hence ``trunc`` before such casts;
sums of integers are HUGEINT, hence the casts to BIGINT.
"""

from __future__ import annotations

from postcluster.params import (
    DEFAULT_PARAMS,
    LANGUAGES,
    MIXED_PARAMS,
    REPORT_HEADER,
    REPORT_LINE_FORMAT,
    ClusterParams,
)


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lang_values(langs) -> str:
    rows = ", ".join(f"({i}, {_quote(name)})" for i, name in enumerate(langs))
    return f"langs(lang_index, lang) AS (VALUES {rows})"


def _lang_list(langs) -> str:
    return "[" + ", ".join(_quote(name) for name in langs) + "]"


def _postings_ctes(langs=LANGUAGES) -> str:
    return f"""
{_lang_values(langs)},
postings AS (
    SELECT 1 AS posting_type,
           CAST(o_orderkey AS INTEGER) AS id,
           CASE WHEN o_orderkey % 3 = 0 THEN CAST(10000001 + o_orderkey * 8 AS INTEGER) END AS accepted_answer,
           CAST(NULL AS INTEGER) AS parent_id,
           CAST(floor(o_totalprice / 10000) AS INTEGER) AS score,
           CASE WHEN o_custkey % 17 = 16 THEN CAST(NULL AS VARCHAR)
                WHEN o_custkey % 17 = 15 THEN 'COBOL'
                ELSE {_lang_list(LANGUAGES)}[CAST(o_custkey % 17 AS INTEGER) + 1] END AS tags
    FROM orders
    UNION ALL
    SELECT 2,
           CAST(10000000 + l_orderkey * 8 + l_linenumber AS INTEGER),
           CAST(NULL AS INTEGER),
           CASE WHEN l_partkey % 50 = 1 THEN CAST(NULL AS INTEGER)
                WHEN l_partkey % 50 = 2 THEN CAST(5000000 + l_orderkey AS INTEGER)
                ELSE CAST(l_orderkey AS INTEGER) END,
           CAST(trunc(l_quantity - 10) AS INTEGER),
           CAST(NULL AS VARCHAR)
    FROM lineitem
    UNION ALL
    SELECT 3, CAST(90000000 + s_suppkey AS INTEGER), CAST(NULL AS INTEGER),
           CAST(NULL AS INTEGER), 0, CAST(NULL AS VARCHAR)
    FROM supplier
),
questions AS (SELECT * FROM postings WHERE posting_type = 1),
answers AS (SELECT * FROM postings WHERE posting_type = 2 AND parent_id IS NOT NULL),
scored AS (
    SELECT q.posting_type, q.id, q.accepted_answer, q.parent_id, q.score, q.tags, b.high_score
    FROM (SELECT DISTINCT posting_type, id, accepted_answer, parent_id, score, tags FROM questions) q
    JOIN (SELECT parent_id AS question_id, max(score) AS high_score FROM answers GROUP BY parent_id) b
      ON q.id = b.question_id
)"""


def _pairs_sql() -> str:
    """The pairs straight from the two tables, without the other postings."""
    return f"""
WITH q AS (
    SELECT CAST(o_orderkey AS INTEGER) AS id,
           CASE WHEN o_orderkey % 3 = 0 THEN CAST(10000001 + o_orderkey * 8 AS INTEGER) END AS accepted_answer,
           CAST(floor(o_totalprice / 10000) AS INTEGER) AS score,
           CASE WHEN o_custkey % 17 = 16 THEN CAST(NULL AS VARCHAR)
                WHEN o_custkey % 17 = 15 THEN 'COBOL'
                ELSE {_lang_list(LANGUAGES)}[CAST(o_custkey % 17 AS INTEGER) + 1] END AS tags
    FROM orders
),
a AS (
    SELECT CAST(10000000 + l_orderkey * 8 + l_linenumber AS INTEGER) AS id,
           CASE WHEN l_partkey % 50 = 2 THEN CAST(5000000 + l_orderkey AS INTEGER)
                ELSE CAST(l_orderkey AS INTEGER) END AS parent_id,
           CAST(trunc(l_quantity - 10) AS INTEGER) AS score
    FROM lineitem WHERE l_partkey % 50 <> 1
)
SELECT q.id AS question_id,
       1 AS q_posting_type, q.id AS q_id, q.accepted_answer AS q_accepted_answer,
       CAST(NULL AS INTEGER) AS q_parent_id, q.score AS q_score, q.tags AS q_tags,
       2 AS a_posting_type, a.id AS a_id, CAST(NULL AS INTEGER) AS a_accepted_answer,
       a.parent_id AS a_parent_id, a.score AS a_score, CAST(NULL AS VARCHAR) AS a_tags
FROM q JOIN a ON q.id = a.parent_id"""


def _vector_ctes(params: ClusterParams) -> str:
    return f"""{_postings_ctes(params.langs)},
vectors AS (
    SELECT s.id, CAST(l.lang_index * {params.spread} AS INTEGER) AS x, s.high_score AS y
    FROM scored s JOIN langs l ON s.tags = l.lang
),
points AS (SELECT x, y, count(*) AS n FROM vectors GROUP BY x, y)"""


def _draw(params: ClusterParams) -> str:
    return f"md5(concat('{int(params.seed)}:', CAST(id AS VARCHAR)))"


def _sample_cte(params: ClusterParams) -> str:
    if params.samples_by_language:
        per = params.per_language
        return f"""
ranked AS (
    SELECT id, x, y,
           row_number() OVER (PARTITION BY x ORDER BY {_draw(params)}, id, y) AS rank
    FROM vectors
),
sample AS (
    SELECT CAST(row_number() OVER (ORDER BY x, rank) - 1 AS INTEGER) AS cluster,
           x, y, id, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE rank <= {per}
)"""
    return f"""
ranked AS (
    SELECT id, x, y, row_number() OVER (ORDER BY {_draw(params)}, id, x, y) AS rank
    FROM vectors
),
sample AS (
    SELECT CAST(rank - 1 AS INTEGER) AS cluster, x, y, id, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE rank <= {params.kernels}
)"""


def _kmeans_cte(params: ClusterParams) -> str:
    """Lloyd iterations as a recursive CTE over the distinct points.

    Row set ``i`` holds the centers after pass ``i`` (0 = the sample).  A
    pass runs while the previous one did not converge and fewer than
    ``max_iterations`` passes have run.  Each point goes to the lowest
    (distance, cluster); a cluster without points keeps its center.
    """
    eta = float(params.eta)
    return f"""
km(iteration, cluster, old_x, old_y, x, y, moved, total_shift, converged) AS (
    SELECT 0, cluster, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), x, y,
           CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), false
    FROM sample
    UNION ALL
    SELECT iteration, cluster, old_x, old_y, x, y, moved,
           sum(moved) OVER () AS total_shift,
           sum(moved) OVER () < {eta} AS converged
    FROM (
        SELECT iteration, cluster, old_x, old_y, x, y,
               (CAST(x AS DOUBLE) - old_x) * (CAST(x AS DOUBLE) - old_x)
             + (CAST(y AS DOUBLE) - old_y) * (CAST(y AS DOUBLE) - old_y) AS moved
        FROM (
            SELECT iteration + 1 AS iteration, cluster, old_x, old_y,
                   CASE WHEN cnt > 0 THEN CAST(sx // cnt AS INTEGER) ELSE old_x END AS x,
                   CASE WHEN cnt > 0 THEN CAST(sy // cnt AS INTEGER) ELSE old_y END AS y
            FROM (
                SELECT iteration, cluster, old_x, old_y,
                       sum(CASE WHEN best THEN CAST(px AS BIGINT) * pn END) AS sx,
                       sum(CASE WHEN best THEN CAST(py AS BIGINT) * pn END) AS sy,
                       sum(CASE WHEN best THEN pn ELSE 0 END) AS cnt
                FROM (
                    SELECT k.iteration, k.cluster, k.x AS old_x, k.y AS old_y,
                           p.x AS px, p.y AS py, p.n AS pn,
                           row_number() OVER (
                               PARTITION BY p.x, p.y
                               ORDER BY (CAST(p.x AS DOUBLE) - k.x) * (CAST(p.x AS DOUBLE) - k.x)
                                      + (CAST(p.y AS DOUBLE) - k.y) * (CAST(p.y AS DOUBLE) - k.y),
                                        k.cluster) = 1 AS best
                    FROM km k CROSS JOIN points p
                    WHERE k.iteration < {int(params.max_iterations)} AND NOT k.converged
                ) AS candidates
                GROUP BY iteration, cluster, old_x, old_y
            ) AS sums
        ) AS moved_centers
    ) AS step
)"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts) + "\n"


def _assign_cte(name: str, centers_sql: str) -> str:
    """Nearest center per distinct point, then per vector."""
    return f"""
{name}_centers AS ({centers_sql}),
{name}_point_cluster AS (
    SELECT x, y, cluster FROM (
        SELECT p.x, p.y, c.cluster,
               row_number() OVER (
                   PARTITION BY p.x, p.y
                   ORDER BY (CAST(p.x AS DOUBLE) - c.x) * (CAST(p.x AS DOUBLE) - c.x)
                          + (CAST(p.y AS DOUBLE) - c.y) * (CAST(p.y AS DOUBLE) - c.y),
                            c.cluster) AS r
        FROM points p CROSS JOIN {name}_centers c
    ) WHERE r = 1
),
{name}_assigned AS (
    SELECT v.id, v.x, v.y, pc.cluster FROM vectors v JOIN {name}_point_cluster pc USING (x, y)
)"""


FINAL_CENTERS = "SELECT cluster, x, y FROM km WHERE iteration = (SELECT max(iteration) FROM km)"


def _summary_select(name: str, params: ClusterParams, exact_percent: bool) -> str:
    if exact_percent:
        percent = "CAST(d.cnt AS DOUBLE) * CAST(100.0 AS DOUBLE) / CAST(d.size AS DOUBLE)"
    else:
        percent = "CAST((d.cnt // d.size) * 100 AS DOUBLE)"
    return f"""
{name}_lang_counts AS (
    SELECT cluster, x, count(*) AS cnt FROM {name}_assigned GROUP BY cluster, x
),
{name}_dominant AS (
    SELECT cluster, x, cnt,
           CAST(sum(cnt) OVER (PARTITION BY cluster) AS BIGINT) AS size,
           row_number() OVER (PARTITION BY cluster ORDER BY cnt DESC, x) AS r
    FROM {name}_lang_counts
),
{name}_medians AS (
    SELECT cluster, CAST(trunc(quantile_cont(y, 0.5)) AS INTEGER) AS median_score
    FROM {name}_assigned GROUP BY cluster
),
{name}_summary AS (
    SELECT CAST(d.cluster AS INTEGER) AS cluster, l.lang AS lang,
           {percent} AS lang_percent,
           d.size AS size, m.median_score AS median_score
    FROM {name}_dominant d
    JOIN {name}_medians m ON m.cluster = d.cluster
    JOIN langs l ON l.lang_index = d.x // {params.spread}
    WHERE d.r = 1
)"""


def _clustered(params: ClusterParams, exact_percent: bool = True, initial: bool = False) -> str:
    centers = "SELECT cluster, x, y FROM sample" if initial else FINAL_CENTERS
    return _with(
        _vector_ctes(params),
        _sample_cte(params),
        _kmeans_cte(params),
        _assign_cte("fin", centers),
        _summary_select("fin", params, exact_percent),
    )


def _report_sql(params: ClusterParams) -> str:
    header = " UNION ALL ".join(
        f"SELECT {i} AS line_no, {_quote(text)} AS line" for i, text in enumerate(REPORT_HEADER)
    )
    return _clustered(params) + f"""
SELECT CAST(line_no AS INTEGER) AS line_no, line FROM ({header})
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY median_score, cluster) + {len(REPORT_HEADER) - 1} AS INTEGER) AS line_no,
       printf({_quote(REPORT_LINE_FORMAT)}, median_score, lang, lang_percent, size) AS line
FROM fin_summary"""


def oracle_queries() -> dict[str, str]:
    p = DEFAULT_PARAMS
    m = MIXED_PARAMS
    base = _with(_postings_ctes())
    vec = _with(_vector_ctes(p))
    vec_sample = _with(_vector_ctes(p), _sample_cte(p))
    step = _with(_vector_ctes(p), _sample_cte(p), _assign_cte("ini", "SELECT cluster, x, y FROM sample"))
    line_count = "SELECT count(*) FROM postings"
    return {
        "raw_posting_count": base + f"""
SELECT 'lines' AS what, ({line_count}) AS row_count
UNION ALL
SELECT 'postings' AS what, ({line_count}) AS row_count""",
        "raw_postings": base + "SELECT * FROM postings",
        "questions": base + "SELECT * FROM questions",
        "answers": base + "SELECT * FROM answers",
        "question_answer_pairs": _pairs_sql(),
        "grouped_postings": base + """
SELECT q.question_id, q.question_postings, a.answers,
       CAST(q.question_postings * a.answers AS BIGINT) AS pairs,
       a.min_answer_id, a.max_answer_id, a.high_score
FROM (SELECT id AS question_id, count(*) AS question_postings FROM questions GROUP BY id) q
JOIN (SELECT parent_id AS question_id, count(*) AS answers, min(id) AS min_answer_id,
             max(id) AS max_answer_id, max(score) AS high_score
      FROM answers GROUP BY parent_id) a
  ON q.question_id = a.question_id""",
        "grouped_posting_count": base + """
SELECT count(DISTINCT q.id) AS groups
FROM questions q WHERE q.id IN (SELECT parent_id FROM answers)""",
        "scored_postings": base + "SELECT * FROM scored",
        "scored_question_lookup": base + """
SELECT w.id, w.ranking, s.id IS NOT NULL AS found
FROM (SELECT DISTINCT id, score AS ranking FROM questions) w
LEFT JOIN (SELECT DISTINCT id, high_score FROM scored) s ON s.id = w.id AND s.high_score = w.ranking""",
        "first_language_index": base + """
SELECT q.id, q.tags, CAST(l.lang_index AS INTEGER) AS lang_index
FROM questions q LEFT JOIN langs l ON q.tags = l.lang""",
        "label_vectors": vec + "SELECT id, x, y FROM vectors",
        "weighted_points": vec + "SELECT x, y, n FROM points",
        "stratified_sample": vec_sample + "SELECT cluster, x, y, id, rank FROM sample",
        "global_sample": _with(_vector_ctes(m), _sample_cte(m))
        + "SELECT cluster, x, y, id, rank FROM sample",
        "nearest_center": step + """
SELECT v.id, v.x, v.y, pc.cluster,
       (CAST(v.x AS DOUBLE) - c.x) * (CAST(v.x AS DOUBLE) - c.x)
     + (CAST(v.y AS DOUBLE) - c.y) * (CAST(v.y AS DOUBLE) - c.y) AS distance
FROM vectors v
JOIN ini_point_cluster pc USING (x, y)
JOIN ini_centers c ON c.cluster = pc.cluster""",
        "center_update": step + """
SELECT c.cluster, c.x AS old_x, c.y AS old_y,
       COALESCE(u.x, c.x) AS x, COALESCE(u.y, c.y) AS y, COALESCE(u.n, 0) AS n
FROM ini_centers c LEFT JOIN (
    SELECT cluster, CAST(sum(CAST(x AS BIGINT)) // count(*) AS INTEGER) AS x,
           CAST(sum(CAST(y AS BIGINT)) // count(*) AS INTEGER) AS y, count(*) AS n
    FROM ini_assigned GROUP BY cluster
) u ON u.cluster = c.cluster""",
        "center_shift": step + f"""
, upd AS (
    SELECT c.cluster, c.x AS old_x, c.y AS old_y,
           COALESCE(u.x, c.x) AS x, COALESCE(u.y, c.y) AS y
    FROM ini_centers c LEFT JOIN (
        SELECT cluster, CAST(sum(CAST(x AS BIGINT)) // count(*) AS INTEGER) AS x,
               CAST(sum(CAST(y AS BIGINT)) // count(*) AS INTEGER) AS y
        FROM ini_assigned GROUP BY cluster
    ) u ON u.cluster = c.cluster
), mv AS (
    SELECT *, (CAST(x AS DOUBLE) - old_x) * (CAST(x AS DOUBLE) - old_x)
            + (CAST(y AS DOUBLE) - old_y) * (CAST(y AS DOUBLE) - old_y) AS moved
    FROM upd
)
SELECT cluster, old_x, old_y, x, y, moved, sum(moved) OVER () AS total_shift,
       sum(moved) OVER () < {float(p.eta)} AS converged
FROM mv""",
        "kmeans_trace": _with(_vector_ctes(p), _sample_cte(p), _kmeans_cte(p)) + """
SELECT CAST(iteration AS INTEGER) AS iteration, cluster, old_x, old_y, x, y, moved, total_shift, converged
FROM km WHERE iteration >= 1""",
        "kmeans_centers": _with(_vector_ctes(p), _sample_cte(p), _kmeans_cte(p)) + FINAL_CENTERS,
        "cluster_language_counts": _with(
            _vector_ctes(p), _sample_cte(p), _kmeans_cte(p), _assign_cte("fin", FINAL_CENTERS)
        ) + """
SELECT a.cluster, l.lang, count(*) AS questions
FROM fin_assigned a JOIN langs l ON l.lang_index = a.x // """ + str(p.spread) + """
GROUP BY a.cluster, l.lang""",
        "cluster_summary": _clustered(p) + "SELECT * FROM fin_summary",
        "cluster_summary_initial": _clustered(p, initial=True) + "SELECT * FROM fin_summary",
        "cluster_summary_mixed": _clustered(m) + "SELECT * FROM fin_summary",
        "cluster_percent_truncated": _clustered(m, exact_percent=False) + "SELECT * FROM fin_summary",
        "cluster_report_lines": _report_sql(p),
        "qa_clusters_end_to_end": _clustered(p) + "SELECT * FROM fin_summary",
    }
