"""Page-line inputs derived from the driver tables, plus the same inputs as DuckDB SQL.

No driver table contains link markup, so each graph is first written as raw
lines.  ``wp`` (part graph: cycles, multi-links, link-only vertices), ``wh``
(web-page graph: duplicate titles, repeated links, non-ASCII text) and ``wd``
(dirty lines exercising every parsing disagreement).  Each builder has a SQL
twin that DuckDB runs on the same parquet tables, so the oracle sees exactly
the lines Spark sees.  Link order inside a WP line is made deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIXTURES = ("wp", "wh", "wd")
HUB = "HUB"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wp_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part graph: part P links to the part on the next line of each order it appears in.

    Every linked pair of every order is used.  Every part has a page
    line; vertices without a page come from WH and WD.
    The input format is one page per line, so a part's links are concatenated
    into its one line here (this builds the test input; the engine itself never
    gathers a page's links into a row).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    a = li.alias("a")
    b = li.alias("b")
    pairs = a.join(
        b,
        (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & (F.col("a.l_linenumber") + 1 == F.col("b.l_linenumber")),
    ).select(
        F.col("a.l_partkey").alias("src"),
        F.struct(
            F.col("a.l_orderkey").alias("o"),
            F.col("a.l_linenumber").alias("n"),
            F.col("b.l_partkey").alias("k"),
        ).alias("key"),
    )
    # links of a part come from orders everywhere, so gathering them before the shuffle would only cost
    bodies = pairs.repartition("src").groupBy("src").agg(F.sort_array(F.collect_list("key"))["k"].cast("array<string>").alias("parts")).select(
        "src", F.array_join("parts", "]] [[P").alias("parts")
    )
    bodies = bodies.select("src", F.when(F.col("parts") != "", F.concat(F.lit("[[P"), "parts", F.lit("]]"))).alias("body"))
    part = table(spark, sf_dir, "part").select("p_partkey")
    return part.join(bodies, part.p_partkey == bodies.src, "left").select(
        F.concat(
            F.lit("<page><title>P"),
            F.col("p_partkey").cast("string"),
            F.lit("</title><text>"),
            F.coalesce(F.col("body"), F.lit("")),
            F.lit("</text></page>"),
        ).alias("value")
    )


WP_SQL = """
select '<page><title>P' || p_partkey || '</title><text>' || coalesce(body, '') || '</text></page>' as value
from part
left join (
  select a.l_partkey as src,
         string_agg('[[P' || b.l_partkey || ']]', ' '
                    order by a.l_orderkey, a.l_linenumber, b.l_partkey) as body
  from lineitem a join lineitem b
    on a.l_orderkey = b.l_orderkey and a.l_linenumber + 1 = b.l_linenumber
  group by a.l_partkey) t on p_partkey = src
"""


def wh_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages with anchors rewritten as [[target]]; line breaks become spaces."""
    html = table(spark, sf_dir, "pages").select("html")
    linked = F.regexp_replace(F.col("html"), r'<a href="/([^"]*)">', "[[$1]]")
    return html.select(F.translate(linked, "\n\r", "  ").alias("value"))


WH_SQL = """
select replace(replace(regexp_replace(html, '<a href="/([^"]*)">', '[[\\1]]', 'g'), chr(10), ' '), chr(13), ' ') as value
from pages
"""

# Dirty lines: every document yields one line; doc_id % 12 only picks which
# parsing case that line exercises (all but the blank one carry the document's text), and the other moduli pick link targets
# (the same CASE text runs in both engines).
WD_CASE = """(case doc_id % 12
 when 0 then ''
 when 1 then 'no heading here [[D'||(doc_id+1)||']]'
 when 2 then '<title lang="x">D'||doc_id||'</title>[[D'||(doc_id%50)||']]'
 when 3 then '<title>D'||(doc_id%50)||chr(9)||'t</title>[[D'||((doc_id+7)%50)||chr(9)||'t]]'
 when 4 then '<title>D'||doc_id||'</title>[[]] [[D'||(doc_id%50)||']]'
 when 5 then '<title>D'||doc_id||'</title>'
 when 6 then '<title>open D'||doc_id||' [[D'||(doc_id%50)||']]'
 when 7 then '<titles>x</titles><title>D'||doc_id||'</title>[[D'||(doc_id%50)||']]'
 when 8 then '<title>D'||(doc_id%50)||' t</title>[[D'||((doc_id*3)%50)||']]'
 when 9 then '<title></title>[[D'||(doc_id%50)||']]'
 else '<title>D'||(doc_id%50)||'</title>[[D'||((doc_id*7+1)%50)||']] [[D'||((doc_id*7+1)%50)||']] [[D'||((doc_id*11)%50)||'|l]] [[D'||((doc_id+13)%50)||']]'
 end)
 || case when doc_id % 12 = 0 then '' else ' '||replace(replace(coalesce(text, ''), chr(10), ' '), chr(13), ' ') end"""


def wd_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.expr(WD_CASE).alias("value"))


WD_SQL = f"select {WD_CASE} as value from documents"

def wk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part graph with a hot page: ``HUB`` has a line with links for each order line, about half of all links."""
    li = table(spark, sf_dir, "lineitem")
    hub = F.concat(F.lit(f"<title>{HUB}</title>[[P"), F.col("l_partkey").cast("string"), F.lit("]] [[S"), F.col("l_suppkey").cast("string"), F.lit("]]"))
    return wp_lines(spark, sf_dir).unionByName(li.select(hub.alias("value")))


WK_SQL = f"""
select * from ({WP_SQL.strip()})
union all
select '<title>{HUB}</title>[[P' || l_partkey || ']] [[S' || l_suppkey || ']]' from lineitem
"""

# Lines with every character at which one of the two dot rules stops: the text decides which come inside of a link or a title.
WS_CASE = """'<title>D' || (case doc_id % 5 when 0 then chr(133) when 1 then chr(8232) when 2 then chr(8233) when 3 then chr(12) else ' ' end) || doc_id || '</title>'
 || '[[a' || chr(133) || doc_id || ']] [[b' || chr(8232) || 'c]] [[d]] [[e' || chr(8233) || '[[f]] [[' || chr(11) || ']] [[D' || (doc_id % 50) || ']] '
 || replace(replace(replace(coalesce(text, ''), chr(10), ' '), chr(13), ' '), ' a ', ' [[x' || chr(8232) || ']] ')"""


def ws_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.expr(WS_CASE.replace("chr(8232)", "'\u2028'").replace("chr(8233)", "'\u2029'").replace("chr(133)", "'\u0085'")).alias("value"))


WS_SQL = f"select {WS_CASE} as value from documents"

BUILDERS = {"wp": wp_lines, "wh": wh_lines, "wd": wd_lines, "wk": wk_lines, "ws": ws_lines}
SQL = {"wp": WP_SQL, "wh": WH_SQL, "wd": WD_SQL, "wk": WK_SQL, "ws": WS_SQL}


def lines(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, sf_dir)


def lines_sql(name: str) -> str:
    return SQL[name].strip()
