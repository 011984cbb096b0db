"""Tables derived from the given ones, as both engines make them, and the register of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_FRAMES = "(VALUES (0),(1),(2),(3),(4),(5),(6),(7)) AS f(frame_idx)"
#: Views over the given tables, as both engines run them; each may use those before it.
VIEWS = {
    "li": """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_returnflag,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS rn FROM {lineitem}""",
    "gt_boxes": """SELECT l_orderkey AS image_id, l_suppkey % 4 + 1 AS category_id, l_orderkey * 100 + rn AS ann_id,
  CAST(l_partkey % 40 AS DOUBLE) * 10 AS x, CAST(l_suppkey % 30 AS DOUBLE) * 10 AS y, CAST(20 + l_quantity AS DOUBLE) AS w,
  20 + CAST(l_partkey % 31 AS DOUBLE) AS h, CASE WHEN l_returnflag = 'R' AND rn = 3 THEN 1 ELSE 0 END AS iscrowd FROM li""",
    "dt_boxes": """SELECT l_orderkey AS image_id, l_suppkey % 4 + 1 AS category_id, l_orderkey * 100 + rn AS det_id,
  CAST(l_partkey % 40 AS DOUBLE) * 10 + CAST(l_partkey % 9 AS DOUBLE) - 4 + CASE WHEN l_partkey % 7 = 0 THEN 500 ELSE 0 END AS x,
  CAST(l_suppkey % 30 AS DOUBLE) * 10 + CAST(l_suppkey % 7 AS DOUBLE) - 3 AS y, CAST(20 + l_quantity AS DOUBLE) AS w,
  20 + CAST(l_partkey % 31 AS DOUBLE) AS h, CAST((l_partkey * 31 + l_suppkey * 17 + rn * 7) % 1000 AS DOUBLE) / 1000 AS score
  FROM li WHERE (l_partkey + rn) % 11 <> 0""",
    "image_np": "SELECT o_orderkey AS image_id, o_custkey AS phrase_id, 640 AS width, 480 AS height FROM {orders}",
    "gt_tracks": f"""SELECT l_orderkey AS video_id, l_suppkey % 4 + 1 AS category_id, l_orderkey * 100 + rn AS track_id, f.frame_idx,
  CAST(l_partkey % 40 AS DOUBLE) * 10 + f.frame_idx * 2 AS x, CAST(l_suppkey % 30 AS DOUBLE) * 10 AS y,
  CAST(20 + l_quantity AS DOUBLE) AS w, 20 + CAST(l_partkey % 31 AS DOUBLE) AS h
  FROM li CROSS JOIN {_FRAMES} WHERE NOT (l_partkey % 5 = 0 AND f.frame_idx IN (2, 3))""",
    "dt_tracks": f"""SELECT l_orderkey AS video_id, l_suppkey % 4 + 1 AS category_id,
  l_orderkey * 100 + rn + CASE WHEN l_partkey % 6 = 0 AND f.frame_idx >= 5 THEN 100000000 ELSE 0 END AS track_id, f.frame_idx,
  CAST(l_partkey % 40 AS DOUBLE) * 10 + f.frame_idx * 2 + CAST((l_partkey + f.frame_idx) % 9 AS DOUBLE) - 4 AS x,
  CAST(l_suppkey % 30 AS DOUBLE) * 10 AS y, CAST(20 + l_quantity AS DOUBLE) AS w, 20 + CAST(l_partkey % 31 AS DOUBLE) AS h,
  CAST((l_partkey * 31 + l_suppkey * 17) % 1000 AS DOUBLE) / 1000 AS score
  FROM li CROSS JOIN {_FRAMES} WHERE (l_partkey + f.frame_idx) % 7 <> 0""",
    "mask_runs": """SELECT b.image_id, b.ann_id, CAST(b.x AS BIGINT) + c.i AS col, CAST(b.y AS BIGINT) AS row_start, CAST(b.h AS BIGINT) AS run_len
  FROM gt_boxes b CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7),(8),(9)) AS c(i)""",
    "dt_runs": """SELECT b.image_id, b.det_id AS ann_id, CAST(b.x AS BIGINT) + c.i AS col, CAST(b.y AS BIGINT) AS row_start, CAST(b.h AS BIGINT) AS run_len
  FROM dt_boxes b CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7),(8),(9)) AS c(i)""",
    "gt_track_runs": """SELECT t.video_id, t.category_id, t.track_id, t.frame_idx, CAST(t.x AS BIGINT) + c.i AS col, CAST(t.y AS BIGINT) AS row_start, CAST(t.h AS BIGINT) AS run_len
  FROM gt_tracks t CROSS JOIN (VALUES (0),(7),(14)) AS c(i)""",
    "dt_track_runs": """SELECT t.video_id, t.category_id, t.track_id, t.frame_idx, t.score, CAST(t.x AS BIGINT) + c.i AS col, CAST(t.y AS BIGINT) + t.frame_idx AS row_start, CAST(t.h AS BIGINT) AS run_len
  FROM dt_tracks t CROSS JOIN (VALUES (0),(7),(14)) AS c(i)""",
    "np": "SELECT *, CASE WHEN is_urgent = 1 THEN 0 ELSE 1 END AS is_exhaustive FROM (SELECT o_orderkey AS image_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_urgent, o_custkey FROM {orders})",
    "dp_objects": """SELECT g.image_id AS datapoint_id, g.ann_id AS object_id, CAST(g.ann_id % 2 AS INT) AS frame, g.x, g.y, CASE WHEN g.ann_id % 23 = 0 THEN 0.0 ELSE g.w END AS w, g.h,
  CASE WHEN g.ann_id % 29 = 0 THEN 0.0 ELSE g.w * g.h END AS area, g.iscrowd FROM gt_boxes g""",
    "dp_targets": "SELECT datapoint_id, CAST(object_id % 3 AS INT) AS query_no, object_id FROM dp_objects WHERE object_id % 7 <> 0",
    "dp_queries": """SELECT n.image_id AS datapoint_id, CAST(q.no AS INT) AS query_no, CAST(q.no % 2 AS INT) AS stage,
  CASE WHEN (n.image_id + q.no) % 11 = 0 THEN 'geometric' WHEN (n.image_id + q.no) % 5 = 0 THEN 'Dog ' ELSE concat('thing ', CAST(n.o_custkey % 7 AS STRING)) END AS query_text,
  n.is_exhaustive, CASE WHEN n.image_id % 3 = 0 THEN NULL ELSE CAST((n.image_id + q.no) % 2 AS INT) END AS is_pixel_exhaustive,
  CASE WHEN (n.image_id + q.no) % 4 = 0 THEN CAST(10 + q.no AS DOUBLE) END AS input_x FROM np n CROSS JOIN (VALUES (0),(1),(2),(3)) AS q(no)""",
}
_GIVEN = ("lineitem", "orders", "part", "documents", "labels")
#: Rows of lineitem that one task takes. Their frames and columns are up to thirty times as many
#: rows and pairs more yet, and sorts of them shall not spill.
PART_ROWS = 40_000


def stay_together(spark: SparkSession, on: bool) -> None:
    """Whether rows that lie together by some of a join's keys are joined where they are. The views
    are dealt by image or video; their frames, columns and pairs are many times their rows, and
    would otherwise be dealt anew for every join on more keys. Joins with tables that lie by
    few values, such as classes, are broadcast."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", str(not on).lower())


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    stay_together(spark, True)
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _GIVEN}
    # dealt by number: by their bytes, the narrow rows of too many images would go to one task
    n = max(spark.sparkContext.defaultParallelism, tables["lineitem"].count() // PART_ROWS)
    tables["lineitem"] = tables["lineitem"].repartition(n, "l_orderkey")
    steps = ", ".join(f"{n} AS ({q})" for n, q in VIEWS.items())
    return spark.sql(f"WITH {steps} SELECT * FROM {name}", **tables)


def as_sql(query: str) -> str:
    steps = ", ".join(f"{n} AS ({q.format(**{t: t for t in _GIVEN})})" for n, q in VIEWS.items())
    return f"WITH {steps} {query}"


_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(sql: str | None = None):
    """Put a query in the register, with the SQL over the views that gives the same rows."""
    def put(f):
        _REGISTRY[f.__name__] = f
        if sql:
            _SQL[f.__name__] = as_sql(sql)
        return f

    return put


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTRY)


def registered_sql() -> dict[str, str]:
    return dict(_SQL)
