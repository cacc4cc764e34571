"""Derived views that turn the relational test tables into tiles, boxes, points and series.

Each view is one SQL text that Spark and other engines run unchanged; ``FX`` keeps them in dependency order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from spanforge.session import table

FX = {
    "fx_trees": """select o_orderkey as tree_id, (o_orderkey*7919 + o_custkey*104729)%6230 as x0, (o_orderkey*6287 + o_custkey*15485863)%6230 as y0,
        (o_orderkey*7919 + o_custkey*104729)%6230 + 8 + o_orderkey%13 as x1, (o_orderkey*6287 + o_custkey*15485863)%6230 + 8 + o_custkey%13 as y1 from orders""",
    "fx_tiles": """select r.i*8+c.i as tile_id, least(c.i*768,5226) as tx0, least(r.i*768,5226) as ty0, least(c.i*768,5226)+1024 as tx1, least(r.i*768,5226)+1024 as ty1,
        c.i=0 as edge_w, c.i=7 as edge_e, r.i=0 as edge_n, r.i=7 as edge_s
        from (values (0),(1),(2),(3),(4),(5),(6),(7)) r(i) cross join (values (0),(1),(2),(3),(4),(5),(6),(7)) c(i)""",
    "fx_det": """select tile_id, tree_id, greatest(x0,tx0) as x0, greatest(y0,ty0) as y0, least(x1+(tile_id+tree_id)%3,tx1) as x1, least(y1,ty1) as y1
        from fx_trees join fx_tiles on x0<tx1 and x1>tx0 and y0<ty1 and y1>ty0""",
    "fx_stitched": """select cast(tile_id as bigint)*100000000+tree_id as id, tile_id, tree_id, x0, y0, x1, y1, (x1-x0)*(y1-y0) as area from (
        select min(tile_id) as tile_id, tree_id, x0, y0, x1, y1 from (select d.* from fx_det d join fx_tiles t on d.tile_id=t.tile_id
          where d.x0>=tx0+case when edge_w then 0 else 6 end and d.x1<=tx1-case when edge_e then 0 else 6 end
            and d.y0>=ty0+case when edge_n then 0 else 6 end and d.y1<=ty1-case when edge_s then 0 else 6 end) s
        group by tree_id, x0, y0, x1, y1) u""",
    "fx_crowns": """select o_orderkey as tree_id, (o_orderkey*7919+o_custkey*104729)%1230 as x0, (o_orderkey*6287+o_custkey*15485863)%1230 as y0,
        (o_orderkey*7919+o_custkey*104729)%1230+8+o_orderkey%13 as x1, (o_orderkey*6287+o_custkey*15485863)%1230+8+o_custkey%13 as y1 from orders""",
    "fx_points": """select l_orderkey, l_linenumber, (l_orderkey*7919+l_partkey*31)%1250 as x, (l_suppkey*6287+l_linenumber*977+l_orderkey*13)%1250 as y,
        l_quantity as z, case when l_linenumber%3=0 then 2 else 1 end as cls from lineitem""",
    "fx_qc": """select c_custkey as id, (c_custkey*7919)%6230 as x0, (c_custkey*104729)%6230 as y0, (c_custkey*7919)%6230+8+c_custkey%43 as x1,
        (c_custkey*104729)%6230+8+c_custkey%37 as y1, case when c_custkey%17=0 then null else c_mktsegment end as qc from customer""",
    "fx_epochs": """select event_id%50+1 as epoch, round(avg(value)+0.00001,4) as train_loss, case when (event_id%50+1)%7=0 then null else round(max(value),4) end as val_loss,
        max(event_id)*1.5 as wall_s from events group by event_id%50""",
}
TABLES = ("orders", "customer", "lineitem", "events", "embeddings", "part", "supplier", "nation", "region")


def _needed(sql: str) -> list[str]:
    """The views that ``sql`` stands on, in dependency order."""
    used: set[str] = set()
    todo = [n for n in FX if re.search(rf"\b{n}\b", sql)]
    while todo:
        name = todo.pop()
        if name not in used:
            used.add(name)
            todo += [n for n in FX if re.search(rf"\b{n}\b", FX[name])]
    return [n for n in FX if n in used]


def with_views(sql: str) -> str:
    """``sql`` with the views it uses as common table expressions."""
    body = sql.strip()
    ctes = ", ".join(f"{n} as ({FX[n]})" for n in _needed(sql))
    if not ctes:
        return body
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes}, {body[15:]}"
    return f"with {ctes}, {body[5:]}" if body.lower().startswith("with ") else f"with {ctes} {body}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view over the tables of ``sf_dir``; it registers nothing in the catalog."""
    sql = with_views(f"select * from {name}")
    tables = [t for t in TABLES if re.search(rf"\bfrom {t}\b", sql)]
    for t in tables:
        sql = re.sub(rf"\bfrom {t}\b", f"from {{{t}}}", sql)
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables})
