"""JSON packing and reading over whole tables."""

from pyspark.sql import functions as F

from ..functions import jsons
from ..operators import jsonpack
from .base import query
from .standin import LAYOUT, domain, load, sources, sql

_DROP = ["PersonID", "VisitDate"]
_PACKED = """
    select "VisitID" as vid, 'Line' as task, to_json({'quantity': round(quantity, 4), 'price': round(price, 4),
        'discount': round(discount, 4), 'flag': flag})::varchar as measures from d_line
    union all select "VisitID", 'Order', to_json({'total': round(total, 4), 'priority': priority})::varchar from d_order
    union all select "VisitID", 'Event', to_json({'kind': kind, 'value': round(value, 4)})::varchar from d_event"""


@query(
    "pack_row_json",
    """select p_partkey, to_json({'p_name': p_name, 'p_brand': p_brand, 'p_type': nullif(p_type, 'SMALL'),
        'p_size': p_size, 'p_retailprice': round(p_retailprice, 4)})::varchar as measures from part""",
)
def _(spark, d):
    part = load(spark, d, "part").withColumn("p_type", F.nullif("p_type", F.lit("SMALL")))
    return jsonpack.pack_row_json(part, ["p_partkey"])


@query("pack_all_tables", sql("d_line d_order d_event", _PACKED))
def _(spark, d):
    tables = LAYOUT.task_tables(sources(spark, d))
    return jsonpack.pack_all_tables(tables, "VisitID", _DROP)


@query(
    "measure_catalogue",
    sql("d_line d_order d_event", f"""select c.task, c.measures, n.n_rows from (values
        ('Line', '["quantity","price","discount","flag"]'), ('Order', '["total","priority"]'),
        ('Event', '["kind","value"]')) as c(task, measures)
        join (select task, count(*) as n_rows from ({_PACKED}) group by task) n on n.task = c.task"""),
)
def _(spark, d):
    tables = LAYOUT.task_tables(sources(spark, d))
    rows = jsonpack.pack_all_tables(tables, "VisitID", _DROP).groupBy("task").agg(F.count(F.lit(1)).alias("n_rows"))
    return jsonpack.measure_catalogue(tables, "VisitID|PersonID|VisitDate").join(rows, "task")


@query(
    "struct_to_json",
    sql("visit_study", "select vid, to_json({'study': study, 'cohort': nullif(cohort, 'N')})::varchar as item from visit_study"),
)
def _(spark, d):
    t = domain(spark, d, "visit_study")["visit_study"].withColumn("cohort", F.nullif("cohort", F.lit("N")))
    return t.select("vid", jsons.struct_to_json("study", "cohort").alias("item"))


@query("explode_json_array", "select conv_id, turn, unnest([role, text]) as value from conversations")
def _(spark, d):
    packed = load(spark, d, "conversations").select(
        "conv_id", "turn", jsons.json_text(F.array("role", "text")).alias("parts")
    )
    return jsonpack.explode_json_array(packed, "parts", "value", ["conv_id", "turn"])


@query(
    "json_element",
    """select doc_id, coalesce(to_json(nullif(source, 'src1'))::varchar, 'null') as as_json, nullif(source, 'src1') as as_text
    from documents""",
)
def _(spark, d):
    arr = jsons.json_text(F.array(F.nullif("source", F.lit("src1")), F.col("lang")))
    return load(spark, d, "documents").select("doc_id", arr.alias("arr")).select(
        "doc_id",
        jsons.json_element("arr", 0).alias("as_json"),
        jsons.json_element("arr", 0, as_text=True).alias("as_text"),
    )


@query(
    "json_contains",
    sql("visit_study", """select vid, bool_or(study = 'Brand#7' and cohort = 'A') as hit from visit_study group by vid"""),
)
def _(spark, d):
    t = domain(spark, d, "visit_study")["visit_study"]
    arrays = t.groupBy("vid").agg(jsons.json_text(F.collect_set(F.struct("study", "cohort"))).alias("studies"))
    return arrays.select("vid", jsons.json_contains("studies", study="Brand#7", cohort="A").alias("hit"))
