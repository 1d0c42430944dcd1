"""Queries of scalar functions, validation, extraction, entity resolution, panels and models over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodeworks.functions import text as fn
from lodeworks.functions import validate as val
from lodeworks.operators import entity, extract, models, panels, reshape

from .q_relational import QUARTERS, quarters, t
from .registry import query

_PAIRS = lambda d: ", ".join(f"'{k}': '{v}'" for k, v in d.items())
_LIST = lambda xs: ", ".join(f"'{x}'" for x in xs)

ADDRESS = "concat(c_custkey, ' N. ', c_mktsegment, ' ', ['St.', 'Ave', 'Terr', 'Way', 'Dr.'][c_custkey % 5 + 1], [', Apt. ', ' #', ', Suite '][c_custkey % 3 + 1], c_nationkey, ', Gainesville, TX ', 76000 + c_nationkey, ['', ', USA'][c_custkey % 2 + 1])"


def addresses(spark, sf_dir):
    pick = lambda xs, n: F.get(F.array(*map(F.lit, xs)), (F.col("c_custkey") % n).cast("int"))
    return t(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment",
        F.concat(
            F.col("c_custkey").cast("string"), F.lit(" N. "), "c_mktsegment", F.lit(" "), pick(("St.", "Ave", "Terr", "Way", "Dr."), 5), pick((", Apt. ", " #", ", Suite "), 3),
            F.col("c_nationkey").cast("string"), F.lit(", Gainesville, TX "), (76000 + F.col("c_nationkey")).cast("string"), pick(("", ", USA"), 2),
        ).alias("address"),
    )


@query("fn01_address_tokens", f"""WITH a AS (SELECT c_custkey, list_filter(string_split_regex(regexp_replace(regexp_replace(regexp_replace(lower(nfc_normalize({ADDRESS})), '(?:apt|apartment|suite|ste|unit|#)\\.?\\s*([0-9a-z][0-9a-z\\-]*)\\b', ' ', 'g'), '[.,]', ' ', 'g'), '\\bsuite\\s+\\d+', ' ', 'g'), '\\s+'), lambda x: x <> '') AS w FROM customer),
m AS (SELECT c_custkey, list_transform(w, lambda x: coalesce(map_extract(MAP {{{_PAIRS(fn.DIRECTIONALS | fn.STREET_TYPES)}}}, x)[1], x)) AS w FROM a)
SELECT c_custkey, nullif(array_to_string(list_filter(w, lambda x: NOT regexp_matches(x, '^\\d{{5}}(-\\d{{4}})?$') AND NOT regexp_matches(x, '^[a-z]{{2}}$') AND x NOT IN ({_LIST(fn.PLACE_WORDS)})), ' '), '') AS address FROM m""")
def fn01(spark, sf_dir):
    """FN-01, ER-10."""
    return addresses(spark, sf_dir).select("c_custkey", fn.address_normalise("address").alias("address"))


@query("fn02_address_parts", """SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS number, lower(c_mktsegment) AS token, CAST(c_nationkey AS VARCHAR) AS unit, CAST(76000 + c_nationkey AS VARCHAR) AS zip FROM customer""")
def fn02(spark, sf_dir):
    """FN-02."""
    return addresses(spark, sf_dir).select("c_custkey", fn.address_parts("address").alias("p")).select("c_custkey", "p.number", "p.token", "p.unit", "p.zip")


_OWNERS = (" L.L.C.", " & Co.", ", Trustee", " INC", " O'Brien Partners Tr", " L.P., et al.", " Ltd Holdings")


@query("fn03_owner_normalise", f"""WITH o AS (SELECT s_suppkey, lower(nfc_normalize(concat(s_name, [{", ".join("'" + o.replace("'", "''") + "'" for o in _OWNERS)}][s_suppkey % 7 + 1]))) AS n FROM supplier),
w AS (SELECT s_suppkey, string_split_regex(regexp_replace(regexp_replace(regexp_replace(n, '\\b([a-z])\\.([a-z])\\.([a-z])\\.', '\\1\\2\\3', 'g'), '\\b([a-z])\\.([a-z])\\.', '\\1\\2', 'g'), '[.,]', ' ', 'g'), '\\s+') AS w FROM o)
SELECT s_suppkey, array_to_string(list_filter(w, lambda x: x <> '' AND x NOT IN ({_LIST(fn.LEGAL_FORMS)})), ' ') AS owner FROM w""")
def fn03(spark, sf_dir):
    """FN-03."""
    ends = F.array(*map(F.lit, _OWNERS))
    s = t(spark, sf_dir, "supplier").select("s_suppkey", F.concat("s_name", F.get(ends, (F.col("s_suppkey") % 7).cast("int"))).alias("n"))
    return s.select("s_suppkey", fn.owner_normalise("n").alias("owner"))


@query("fn04_slug", """SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, trim(string_split(p_brand, '#')[-1]) AS tail FROM part""")
def fn04(spark, sf_dir):
    """FN-04, FN-05, FN-06."""
    return t(spark, sf_dir, "part").select("p_partkey", fn.slug("p_name").alias("slug"), fn.last_part("p_brand", "#").alias("tail"))


@query("fn07_currency_clean", """SELECT o_orderkey, TRY_CAST(regexp_replace(x, '[^\\d.\\-]', '', 'g') AS DOUBLE) AS amount FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN concat('$', o_custkey, '.50') WHEN 1 THEN concat('(', o_custkey, ')') WHEN 2 THEN concat(o_custkey, '-2') ELSE 'n/a' END AS x FROM orders)""")
def fn07(spark, sf_dir):
    """FN-07, FN-08, FN-09."""
    k, s = F.col("o_orderkey") % 4, F.col("o_custkey").cast("string")
    x = F.when(k == 0, F.concat(F.lit("$"), s, F.lit(".50"))).when(k == 1, F.concat(F.lit("("), s, F.lit(")"))).when(k == 2, F.concat(s, F.lit("-2"))).otherwise("n/a")
    return t(spark, sf_dir, "orders").select("o_orderkey", fn.currency(x).alias("amount"))


@query("fn10_dollars", """SELECT p_partkey, TRY_CAST(replace(regexp_extract(x, '\\$\\s*([\\d,]+(?:\\.\\d+)?)', 1), ',', '') AS DOUBLE) AS low, TRY_CAST(replace(regexp_extract_all(x, '\\$\\s*([\\d,]+(?:\\.\\d+)?)', 1)[-1], ',', '') AS DOUBLE) AS high
FROM (SELECT p_partkey, concat('from $', p_size, ' to $1,', 100 + p_size, '.50 a month') AS x FROM part)""")
def fn10(spark, sf_dir):
    """FN-10, FN-11."""
    x = F.concat(F.lit("from $"), F.col("p_size").cast("string"), F.lit(" to $1,"), (100 + F.col("p_size")).cast("string"), F.lit(".50 a month"))
    return t(spark, sf_dir, "part").select("p_partkey", fn.first_dollars(x).alias("low"), fn.last_dollars(x).alias("high"))


@query("fn12_beds", """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_size END AS beds, CASE WHEN p_size % 5 = 0 THEN 'Studio' ELSE concat(p_size, 'BR') END AS label FROM part""")
def fn12(spark, sf_dir):
    """FN-12, FN-13, FN-15, FN-17, FN-41."""
    x = F.when(F.col("p_size") % 5 == 0, "Studio unit").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" bed")))
    return t(spark, sf_dir, "part").select("p_partkey", fn.beds(x).alias("beds")).select("p_partkey", "beds", fn.beds_label("beds").alias("label"))


@query("fn14_status_alias", """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('O') THEN 'Occupied' WHEN o_orderstatus IN ('O', 'P') THEN 'Notice' ELSE o_orderstatus END AS status FROM orders""")
def fn14(spark, sf_dir):
    """FN-14, FN-38: the first alias list wins."""
    return t(spark, sf_dir, "orders").select("o_orderkey", fn.alias_of("o_orderstatus", {"Occupied": ["o"], "Notice": ["O", "p"]}).alias("status"))


@query("fn16_longest_prefix", """SELECT p_partkey, CASE WHEN starts_with(p_brand, 'Brand#1') THEN CASE WHEN starts_with(p_brand, 'Brand#11') THEN '11' ELSE '1' END WHEN starts_with(p_brand, 'Brand#2') THEN '2' END AS bed FROM part""")
def fn16(spark, sf_dir):
    """FN-16."""
    return t(spark, sf_dir, "part").select("p_partkey", fn.longest_prefix("p_brand", {"brand#1": "1", "BRAND#11": "11", "brand#2": "2"}).alias("bed"))


@query("fn18_multi_date", """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def fn18(spark, sf_dir):
    """FN-18, FN-19, FN-20."""
    k = F.col("o_orderkey") % 3
    x = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "M/d/yyyy")).otherwise("soon")
    return t(spark, sf_dir, "orders").select("o_orderkey", fn.iso_date(x).alias("day"))


@query("fn21_quarter_parse", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INT) END AS q, CASE o_orderkey % 4 WHEN 1 THEN 'forecast' WHEN 3 THEN NULL ELSE 'actual' END AS kind FROM orders""")
def fn21(spark, sf_dir):
    """FN-21, FN-22."""
    k = F.col("o_orderkey") % 4
    base = F.concat(F.year("o_orderdate").cast("string"), F.lit(" Q"), F.quarter("o_orderdate").cast("string"))
    x = F.when(k == 0, base).when(k == 1, F.concat(base, F.lit(" EST"))).when(k == 2, F.concat(base, F.lit(" QTD"))).otherwise(F.date_format("o_orderdate", "MMMM yyyy"))
    return t(spark, sf_dir, "orders").select("o_orderkey", fn.quarter(x).alias("q"), fn.quarter_kind(x).alias("kind"))


@query("fn23_codes", """SELECT c_custkey, concat('C', substr(CAST(10000 + c_custkey % 90000 AS VARCHAR), 1, 4)) AS area, concat(lpad(CAST(c_nationkey AS VARCHAR), 2, '0'), lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')) AS fips FROM customer""")
def fn23(spark, sf_dir):
    """FN-23, FN-24, FN-25."""
    c = t(spark, sf_dir, "customer")
    return c.select("c_custkey", fn.area_code((10000 + F.col("c_custkey") % 90000).cast("string")).alias("area"), fn.fips(F.col("c_nationkey").cast("string"), (F.col("c_custkey") % 1000).cast("string")).alias("fips"))


@query("fn27_haversine", """SELECT vec_id, round(2 * 3958.8 * asin(sqrt(pow(sin((radians(x) - radians(33.6)) / 2), 2) + cos(radians(33.6)) * cos(radians(x)) * pow(sin((radians(y) - radians(-97.1)) / 2), 2))), 3) AS miles
FROM (SELECT vec_id, 33 + CAST(embedding[1] AS DOUBLE) AS x, -97 + CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)""")
def fn27(spark, sf_dir):
    """FN-27."""
    at = lambda i, d: F.get("embedding", F.lit(i)).cast("double") + d
    return t(spark, sf_dir, "embeddings").select("vec_id", F.round(fn.haversine_miles(F.lit(33.6), F.lit(-97.1), at(0, 33), at(1, -97)), 3).alias("miles"))


@query("fn28_sha1", "SELECT c_custkey, concat('p_', substr(sha1(concat(c_name, '|', c_nationkey)), 1, 12)) AS id FROM customer")
def fn28(spark, sf_dir):
    """FN-28."""
    return t(spark, sf_dir, "customer").select("c_custkey", fn.hashed_id("c_name", F.col("c_nationkey").cast("string")).alias("id"))


@query("fn30_size_class", """SELECT p_partkey, CASE WHEN p_size >= 50 THEN 'mf-large' WHEN p_size >= 5 THEN 'mf-small' WHEN p_size = 4 THEN 'fourplex' WHEN p_size = 2 THEN 'duplex' ELSE 'mf-small' END AS kind FROM part""")
def fn30(spark, sf_dir):
    """FN-30."""
    return t(spark, sf_dir, "part").select("p_partkey", fn.size_class("p_size").alias("kind"))


@query("fn32_free_months", """SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN round(p_size / CAST(4.33 AS DOUBLE), 2) WHEN 1 THEN CAST(p_size AS DOUBLE) ELSE 0 END AS free FROM part""")
def fn32(spark, sf_dir):
    """FN-32, FN-45."""
    n, k = F.col("p_size").cast("string"), F.col("p_size") % 3
    x = F.when(k == 0, F.concat(F.lit("Now "), n, F.lit(" Weeks free, 9 months free"))).when(k == 1, F.concat(n, F.lit(" months FREE"))).otherwise("call us")
    return t(spark, sf_dir, "part").select("p_partkey", fn.free_months(x).alias("free"))


@query("fn43_strip_tags", """SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>|<!--.*?-->|<[^>]+>', ' ', 'g'),
'&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g'))) AS digest FROM pages""")
def fn43(spark, sf_dir):
    """FN-43."""
    return t(spark, sf_dir, "pages").select("page_id", F.md5(fn.strip_tags("html")).alias("digest"))


def score_sql(x: str, high: float, moderate: float, invert: bool) -> str:
    """SQL of a risk dimension's score, 25 points at most."""
    h, m = f"CAST({high} AS DOUBLE)", f"CAST({moderate} AS DOUBLE)"
    part = f"least(24, greatest(1, CAST(trunc(25 * {{}}) AS INT)))"  # noqa: F541
    if invert:
        return f"CASE WHEN {x} IS NULL THEN 12 WHEN {x} >= {m} THEN 25 WHEN {x} > {h} THEN {part.format(f'(({x} - {h}) / ({m} - {h}))')} ELSE 0 END"
    return f"CASE WHEN {x} IS NULL THEN 12 WHEN {x} < {m} THEN 25 WHEN {x} < {h} THEN {part.format(f'(1 - ({x} - {m}) / ({h} - {m}))')} ELSE 0 END"


@query("fn47_dimension_score", f"""SELECT o_orderpriority, q, {score_sql('x', 0.15, 0.04, False)} AS score, {score_sql('x', 0.04, 0.15, True)} AS inverted FROM (SELECT o_orderpriority, q, (n % 40) / 200 AS x FROM {QUARTERS})""")
def fn47(spark, sf_dir):
    """FN-47: both directions, thresholds themselves included."""
    x = (F.col("n") % 40) / 200
    return quarters(spark, sf_dir).select("o_orderpriority", "q", fn.dimension_score(x, 0.15, 0.04, 25).alias("score"), fn.dimension_score(x, 0.04, 0.15, 25, True).alias("inverted"))


@query("fn_natural_key", """SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(p_brand, '(\\d+|\\D+)'), lambda p: CASE WHEN regexp_matches(p, '^\\d') THEN lpad(p, 10, '0') ELSE lower(p) END), '') AS k FROM part""")
def fn_natural(spark, sf_dir):
    """WIN-24."""
    return t(spark, sf_dir, "part").select("p_partkey", fn.natural_key("p_brand").alias("k"))


@query("fn_json_props", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def fn_json(spark, sf_dir):
    """FN-44: JSON fields by a schema."""
    return t(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


# ------------------------------------------------------------------ projections, filters, validation


@query("prj01_conform", """SELECT p_partkey AS id, coalesce(CAST(trunc(p_retailprice) AS BIGINT), 0) AS price, p_brand AS brand, NULL::VARCHAR AS note, CAST(0 AS INT) AS units FROM (SELECT *, NULL AS u FROM part)""")
def prj01(spark, sf_dir):
    """PRJ-01, PRJ-02, PRJ-03."""
    p = t(spark, sf_dir, "part").withColumn("units", F.lit(None).cast("int"))
    return reshape.conform(p, {"id": "long", "price": "bigint", "brand": "string", "note": "string", "units": "int"}, {"p_partkey": "id", "p_retailprice": "price", "p_brand": "brand"})


@query("prj07_filters", """SELECT count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F' AND l_shipdate >= TIMESTAMP '1995-01-01'""")
def prj07(spark, sf_dir):
    """PRJ-07, PRJ-08, PRJ-13: IN lists and ranges that reach the scan."""
    f = F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") == "F") & (F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp"))
    return t(spark, sf_dir, "lineitem").where(f).agg(F.count("*").alias("n"))


@query("prj14_parcel_predicate", """SELECT c_custkey FROM customer WHERE regexp_matches(c_name, '[1-9]$') AND (c_mktsegment = 'BUILDING' OR upper(c_name) LIKE '%9%') AND upper(c_name) NOT LIKE '%77%' AND c_custkey NOT IN (19, 29)""")
def prj14(spark, sf_dir):
    """PRJ-14, PRJ-19, PRJ-25."""
    name = F.upper("c_name")
    return t(spark, sf_dir, "customer").where(F.col("c_name").rlike("[1-9]$") & ((F.col("c_mktsegment") == "BUILDING") | name.like("%9%")) & ~name.like("%77%") & ~F.col("c_custkey").isin(19, 29)).select("c_custkey")


@query("prj15_range_validate", """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_quantity END AS l_quantity, CASE WHEN l_discount BETWEEN 0 AND 0.08 THEN l_discount END AS l_discount,
concat_ws(',', CASE WHEN NOT l_quantity BETWEEN 5 AND 45 THEN 'l_quantity_out_of_range' END, CASE WHEN NOT l_discount BETWEEN 0 AND 0.08 THEN 'l_discount_out_of_range' END) AS issues FROM lineitem""")
def prj15(spark, sf_dir):
    """PRJ-15."""
    df = val.range_validate(t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"), {"l_quantity": (5, 45), "l_discount": (0, 0.08)})
    return df.withColumn("issues", F.array_join("issues", ","))


STRONG = [("dollar", r"\$\d"), ("sale", "(?i)for sale")]
WEAK = [("the", r"(?i)\bthe\b"), ("und", r"(?i)\bund\b"), ("des", r"(?i)\bdes\b"), ("mail", "@")]


@query("prj16_strong_weak_regex", """SELECT doc_id, CASE WHEN regexp_matches(text, '\\$\\d') THEN 'dollar' WHEN regexp_matches(text, '(?i)for sale') THEN 'sale' WHEN len(w) >= 2 THEN concat('weak:', array_to_string(w[1:2], '+')) END AS label FROM
(SELECT doc_id, text, list_filter([CASE WHEN regexp_matches(text, '(?i)\\bthe\\b') THEN 'the' END, CASE WHEN regexp_matches(text, '(?i)\\bund\\b') THEN 'und' END, CASE WHEN regexp_matches(text, '(?i)\\bdes\\b') THEN 'des' END, CASE WHEN contains(text, '@') THEN 'mail' END], lambda x: x IS NOT NULL) AS w FROM documents)""")
def prj16(spark, sf_dir):
    """PRJ-16, PRJ-17."""
    return t(spark, sf_dir, "documents").select("doc_id", val.strong_or_weak(F.col("text"), STRONG, WEAK).alias("label"))


@query("prj18_validation_report", """SELECT c_custkey, 'c_mktsegment' AS field, 'missing' AS problem FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS s FROM customer) WHERE s IS NULL
UNION ALL SELECT c_custkey, 'day', 'not_iso' FROM customer WHERE c_custkey % 3 = 0""")
def prj18(spark, sf_dir):
    """PRJ-18."""
    c = t(spark, sf_dir, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"), F.when(F.col("c_custkey") % 3 == 0, "1/2/2024").otherwise("2024-01-02").alias("day"))
    return val.validation_report(c, "c_custkey", ["c_custkey", "c_mktsegment"], ["day"])


@query("prj31_url_host", """SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/:?#]+)', 1)) AS host, lower(regexp_extract(url, '://([^/:?#]+)', 1)) = 'example.net' OR ends_with(lower(regexp_extract(url, '://([^/:?#]+)', 1)), '.example.net') AS listed FROM pages""")
def prj31(spark, sf_dir):
    """PRJ-31."""
    return t(spark, sf_dir, "pages").select("page_id", fn.url_host("url").alias("host"), fn.host_listed(fn.url_host("url"), ["example.net"]).alias("listed"))


@query("prj32_policy_filter", """SELECT doc_id FROM documents WHERE NOT (contains(lower(source), 'src1') OR contains(lower(text), 'password') OR contains(lower(text), 'license'))""")
def prj32(spark, sf_dir):
    """PRJ-32, PRJ-27."""
    return t(spark, sf_dir, "documents").where(~val.policy_excluded(F.col("source"), F.col("text"), ["src1"], ["password", "license"])).select("doc_id")


@query("prj29_soft_block", """SELECT page_id, CASE WHEN regexp_matches(lower(html), 'captcha|access denied|are you a robot') THEN 'blocked' WHEN regexp_matches(lower(html), 'no results|0 results found') THEN 'empty' WHEN length(html) < 500 OR contains(lower(html), 'enable javascript') THEN 'shell' END AS kind FROM pages""")
def prj29(spark, sf_dir):
    """PRJ-29, PRJ-30, PRJ-35."""
    return t(spark, sf_dir, "pages").select("page_id", val.soft_block(F.col("html")).alias("kind"))


@query("prj33_quality_gate", """SELECT o_custkey, count(*) >= least(8, greatest(1, floor(sum(o_orderkey % 50) / 20))) AND count(*) FILTER (o_totalprice > 100000) >= 2 AS passes FROM orders GROUP BY 1""")
def prj33(spark, sf_dir):
    """PRJ-33, PRJ-34, PRJ-36."""
    g = t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(F.col("o_orderkey") % 50).alias("units"), F.count_if(F.col("o_totalprice") > 100000).alias("priced"))
    return g.select("o_custkey", val.quality_gate(F.col("units"), F.col("n"), F.col("priced")).alias("passes"))


@query("prj37_panel_gates", f"""SELECT count(*) AS n, CAST(max(q) - min(q) + 1 - count(DISTINCT q) AS BIGINT) AS gaps, CASE WHEN count(*) < 20 THEN 'Insufficient history' WHEN max(q) - min(q) + 1 - count(DISTINCT q) > 2 THEN 'Too many gaps' WHEN max(v) > 0.5 OR min(v) < 0 THEN 'Vacancy out of plausible range' WHEN min(v) < -0.3 OR max(v) > 0.3 THEN 'Growth out of plausible range' END AS reason
FROM (SELECT q, (n % 70) / 100 AS v FROM {QUARTERS} WHERE o_orderpriority = '5-LOW')""")
def prj37(spark, sf_dir):
    """PRJ-37, PRJ-38."""
    p = quarters(spark, sf_dir).where("o_orderpriority = '5-LOW'").withColumn("v", (F.col("n") % 70) / 100)
    return val.panel_gates(p, "q", "v", "v", 20)


# ------------------------------------------------------------------ extraction


@query("ext_title_links", """SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title, len(regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>')) AS n_links FROM pages""")
def ext_title(spark, sf_dir):
    """Titles and number of links of pages."""
    p = t(spark, sf_dir, "pages")
    n = F.size(F.regexp_extract_all("html", F.lit(r'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'), F.lit(0))).cast("long")
    return p.select("page_id", extract.title("html").alias("title"), n.alias("n_links"))


@query("ext_links", """WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>')) AS x, generate_subscripts(regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'), 1) AS i FROM pages)
SELECT page_id, CAST(i - 1 AS INT) AS pos, regexp_extract(x, '(?i)href="([^"]*)"', 1) AS href FROM a""")
def ext_links(spark, sf_dir):
    """A row a link."""
    return extract.links(t(spark, sf_dir, "pages"), "page_id", "html").select("page_id", "pos", "href")


@query("ext_paragraphs", """WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<p[^>]*>(.*?)</p>', 1)) AS x FROM pages) SELECT page_id, count(*) AS n, CAST(sum(length(x)) AS BIGINT) AS chars FROM a GROUP BY 1""")
def ext_paragraphs(spark, sf_dir):
    """Repeated blocks of a page."""
    rows = t(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<p[^>]*>(.*?)</p>"), F.lit(1))).alias("x"))
    return rows.groupBy("page_id").agg(F.count("*").alias("n"), F.sum(F.length("x")).alias("chars"))


# ------------------------------------------------------------------ entity resolution, panels, models


@query("er01_match_keys", """SELECT c_custkey, concat_ws('|', CAST(76000 + c_nationkey AS VARCHAR), CAST(c_custkey AS VARCHAR), lower(c_mktsegment), CAST(c_nationkey % 4 AS VARCHAR)) AS parts FROM customer""")
def er01(spark, sf_dir):
    """ER-01."""
    a = addresses(spark, sf_dir)
    return a.select("c_custkey", entity.match_keys(F.col("address"), F.col("c_nationkey") % 4, F.lit(1), F.col("c_acctbal"), F.col("c_acctbal"))["parts"].alias("parts"))


@query("er_fold_dedup")
def er_fold(spark, sf_dir):
    """ER-02 to ER-06: the fold over documents as listings (texts as addresses)."""
    d = t(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"), F.col("text").alias("addr"), (F.length("lang") + F.col("n_chars") % 3).cast("double").alias("beds"), (F.col("n_chars") % 2).cast("double").alias("baths"),
        F.col("source").alias("zip"), F.col("lang").alias("number"), F.regexp_extract("text", r"^\S*", 0).alias("token"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"),
    )
    return entity.fold(d)


_PANEL = f"""SELECT o_orderpriority, q, q >= 7990 AS is_forecast, CASE WHEN q % 11 <> 0 THEN CAST(n * 10 AS DOUBLE) END AS inventory_units, CASE WHEN q % 13 <> 0 THEN (n % 20) / 100 END AS vacancy_rate, 0.05 AS stabilized_vacancy,
CAST(n % 30 AS DOUBLE) AS under_construction, CAST(n % 17 AS DOUBLE) AS deliveries, CAST(n % 40 AS DOUBLE) AS deliveries_12mo, CAST(n % 50 - 10 AS DOUBLE) AS absorption_units_12mo, (n % 8) / 100 - CAST(0.03 AS DOUBLE) AS effective_rent_growth_yoy FROM {QUARTERS}"""


def order_panel(spark, sf_dir):
    """Orders by priority as a submarket's quarters."""
    n = F.col("n")
    return quarters(spark, sf_dir).select(
        "o_orderpriority", "q", (F.col("q") >= 7990).alias("is_forecast"), F.when(F.col("q") % 11 != 0, (n * 10).cast("double")).alias("inventory_units"),
        F.when(F.col("q") % 13 != 0, (n % 20) / 100).alias("vacancy_rate"), F.lit(0.05).alias("stabilized_vacancy"), (n % 30).alias("under_construction"), (n % 17).alias("deliveries"),
        (n % 40).alias("deliveries_12mo"), (n % 50 - 10).alias("absorption_units_12mo"), ((n % 8) / 100 - F.lit(0.03)).alias("effective_rent_growth_yoy"),
    )


_W = "(PARTITION BY o_orderpriority ORDER BY q"
_PAN01 = f"""WITH p AS ({_PANEL}), a AS (SELECT *, inventory_units * (1 - vacancy_rate) AS occ, last_value(inventory_units IGNORE NULLS) OVER {_W} ROWS UNBOUNDED PRECEDING) AS inv FROM p),
b AS (SELECT *, occ - lag(occ) OVER {_W}) AS ab, inv / nullif(lag(inv, 4) OVER {_W}), 0) - 1 AS gr FROM a),
c AS (SELECT *, deliveries - coalesce(ab, 0) AS ex, CASE WHEN count(vacancy_rate) OVER {_W} ROWS UNBOUNDED PRECEDING) >= 8 THEN avg(vacancy_rate) OVER {_W} ROWS UNBOUNDED PRECEDING) END AS eq,
CASE WHEN count(ab) OVER {_W} ROWS 3 PRECEDING) >= 2 THEN avg(ab) OVER {_W} ROWS 3 PRECEDING) END AS pace, lag(inventory_units, 4) OVER {_W}) * CASE WHEN count(gr) OVER {_W} ROWS 7 PRECEDING) >= 8 THEN avg(gr) OVER {_W} ROWS 7 PRECEDING) END AS organic FROM b)
SELECT o_orderpriority, q, round(vacancy_rate - CAST(0.05 AS DOUBLE), 6) AS vacancy_gap, round(under_construction / nullif(inventory_units, 0), 6) AS uc_share, round(deliveries_12mo / nullif(inventory_units, 0), 6) AS deliveries_12mo_share,
round(absorption_units_12mo / nullif(inventory_units, 0), 6) AS absorption_12mo_share, round(absorption_units_12mo / nullif(deliveries_12mo, 0), 6) AS absorption_delivery_ratio, round(occ, 6) AS occupied_units, round(ab, 6) AS quarterly_absorption_implied,
round(ex, 6) AS quarterly_excess, round(sum(ex) OVER {_W} ROWS UNBOUNDED PRECEDING), 4) AS cumulative_net_surplus, round(eq, 6) AS equilibrium_vacancy, round((vacancy_rate - eq) * inventory_units, 4) AS units_to_equilibrium,
CASE WHEN pace > 0 THEN round((vacancy_rate - eq) * inventory_units / pace, 4) END AS quarters_to_equilibrium, round(gr, 6) AS inventory_growth_yoy, CASE WHEN organic > 0 THEN round(deliveries_12mo / organic, 4) END AS delivery_vs_organic_growth,
round((deliveries_12mo - absorption_units_12mo) / nullif(inventory_units, 0), 6) AS supply_pressure FROM c"""
_PLACES = {"cumulative_net_surplus": 4, "units_to_equilibrium": 4, "quarters_to_equilibrium": 4, "delivery_vs_organic_growth": 4}


@query("pan01_panel", _PAN01)
def pan01(spark, sf_dir):
    """PAN-01: every derived column, with gaps in inventory and vacancy."""
    p = panels.submarket_panel(order_panel(spark, sf_dir), ["o_orderpriority"])
    return p.select("o_orderpriority", "q", *(F.round(c, _PLACES.get(c, 6)).alias(c) for c in panels.DERIVED))


@query("pan02_cross_tier", f"""SELECT 'all' AS market, q, max(n) FILTER (o_orderpriority = '5-LOW') AS inventory, max(n) FILTER (o_orderpriority = '1-URGENT') AS high_inventory, CAST(sum(n) AS BIGINT) AS total_inventory,
round(max(n) FILTER (o_orderpriority = '1-URGENT') / sum(n), 4) AS high_share FROM {QUARTERS} GROUP BY q HAVING max(n) FILTER (o_orderpriority = '5-LOW') IS NOT NULL""")
def pan02(spark, sf_dir):
    """PAN-02."""
    p = quarters(spark, sf_dir).select(F.lit("all").alias("market"), "o_orderpriority", "q", F.col("n").alias("inventory"), F.col("total").alias("rent"))
    return panels.cross_tier(p, "market", "o_orderpriority", "5-LOW", "1-URGENT").select("market", "q", "inventory", "high_inventory", "total_inventory", F.round("high_share", 4).alias("high_share"))


@query("pan03_metro_panel", f"""WITH p AS ({_PANEL}), g AS (SELECT q, bool_or(is_forecast) AS is_forecast, coalesce(sum(inventory_units), 0) AS inv, sum(under_construction) AS uc, sum(deliveries_12mo) AS d12, sum(absorption_units_12mo) AS a12,
sum(vacancy_rate * inventory_units) FILTER (vacancy_rate IS NOT NULL AND inventory_units IS NOT NULL) / nullif(sum(inventory_units) FILTER (vacancy_rate IS NOT NULL AND inventory_units IS NOT NULL), 0) AS vac, count(*) AS n FROM p GROUP BY 1)
SELECT q, is_forecast, inv AS inventory_units, round(vac, 6) AS vacancy_rate, n AS submarket_count, round(uc / nullif(inv, 0), 6) AS uc_share, round((d12 - a12) / nullif(inv, 0), 6) AS supply_pressure,
round(CASE WHEN d12 > 0 THEN a12 / d12 WHEN a12 >= 0 THEN 2 ELSE 0 END, 6) AS absorption_delivery_ratio FROM g""")
def pan03(spark, sf_dir):
    """PAN-03: submarkets of a metro summed and weighted."""
    p = panels.submarket_panel(order_panel(spark, sf_dir), ["o_orderpriority"]).withColumn("metro", F.lit("all"))
    m = panels.metro_panel(p, ["metro"])
    return m.select("q", "is_forecast", "inventory_units", F.round("vacancy_rate", 6).alias("vacancy_rate"), "submarket_count", *(F.round(c, 6).alias(c) for c in ("uc_share", "supply_pressure", "absorption_delivery_ratio")))


_METRICS = f"""WITH p AS ({_PANEL}), r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, is_forecast ORDER BY CASE WHEN is_forecast THEN q ELSE -q END) AS k FROM p),
l AS (SELECT *, inventory_units AS inv FROM r WHERE k = 1 AND NOT is_forecast), s AS (SELECT o_orderpriority, sum(deliveries) FILTER (is_forecast) AS nx, sum(deliveries) FILTER (NOT is_forecast) AS la FROM r WHERE k <= 4 GROUP BY 1),
m AS (SELECT o_orderpriority, q AS as_of, under_construction / nullif(inv, 0) AS a, CASE WHEN nx IS NOT NULL AND inv > 0 THEN nx / inv ELSE deliveries_12mo / nullif(inv, 0) END AS b,
CASE WHEN la > 0 THEN absorption_units_12mo / la WHEN absorption_units_12mo >= 0 THEN 2 WHEN absorption_units_12mo < 0 THEN 0 END AS c, effective_rent_growth_yoy AS d FROM l JOIN s USING (o_orderpriority))"""


@query("pan08_risk_score", f"""{_METRICS}, x AS (SELECT *, {' + '.join(score_sql(v, *d[2:]) for v, d in zip("abcd", panels.DIMENSIONS, strict=True))} AS score FROM m)
SELECT o_orderpriority, as_of, CAST(score AS INT) AS score, CASE WHEN score >= 70 THEN 'PROCEED' WHEN score >= 40 THEN 'CAUTION' ELSE 'PASS' END AS verdict FROM x""")
def pan08(spark, sf_dir):
    """PAN-08: all four dimensions from a panel."""
    p = panels.submarket_panel(order_panel(spark, sf_dir), ["o_orderpriority"])
    return panels.risk_score(p, ["o_orderpriority"]).select("o_orderpriority", "as_of", "score", "verdict")


@query("pan04_usable", f"""SELECT o_orderpriority, q, coalesce(count(a) OVER w >= 20 AND max(a) OVER w - min(a) OVER w + 1 - count(a) OVER w <= 2, false) AS usable FROM (SELECT *, CASE WHEN NOT is_forecast THEN q END AS a FROM ({_PANEL})) WINDOW w AS (PARTITION BY o_orderpriority)""")
def pan04(spark, sf_dir):
    """PAN-04: the gates of a panel's history."""
    return panels.split_actual(order_panel(spark, sf_dir), ["o_orderpriority"], least=20).select("o_orderpriority", "q", "usable")


@query("mod01_ols", """SELECT p_brand, count(*) AS n, round(regr_slope(p_retailprice, p_size), 4) AS p_size, round(regr_intercept(p_retailprice, p_size), 4) AS intercept, round(regr_r2(p_retailprice, p_size), 4) AS r2 FROM part GROUP BY 1 HAVING count(*) >= 8""")
def mod01(spark, sf_dir):
    """MOD-01: normal equations from one pass of sums."""
    m = models.ols(t(spark, sf_dir, "part"), ["p_brand"], "p_retailprice", ["p_size"])
    return m.select("p_brand", "n", *(F.round(c, 4).alias(c) for c in ("p_size", "intercept", "r2")))


@query("mod12_backtest")
def mod12(spark, sf_dir):
    """MOD-06, WIN-11: one-step backtests of models of one series at every origin."""
    bt = models.backtest(quarters(spark, sf_dir).withColumn("n", F.col("n").cast("double")), ["o_orderpriority"], "q", "n")
    return bt.select("o_orderpriority", "model", "q", *(F.round(c, 4).alias(c) for c in ("actual", "predicted", "lo", "hi")))


@query("mod14_ensemble", f"""WITH b AS (SELECT o_orderpriority, q, n, lag(n) OVER (PARTITION BY o_orderpriority ORDER BY q) AS n1, lag(n, 4) OVER (PARTITION BY o_orderpriority ORDER BY q) AS n4 FROM {QUARTERS}),
e AS (SELECT o_orderpriority, 1 / sqrt(avg((n - n1) * (n - n1))) AS a, 1 / sqrt(avg((n - n4) * (n - n4))) AS c FROM b WHERE n4 IS NOT NULL GROUP BY 1)
SELECT o_orderpriority, q, round((n1 * a + n4 * c) / (a + c), 4) AS predicted FROM b JOIN e USING (o_orderpriority) WHERE n4 IS NOT NULL""")
def mod14(spark, sf_dir):
    """MOD-14: inverse-RMSE ensemble of persistence and last year's value."""
    w = Window.partitionBy("o_orderpriority").orderBy("q")
    b = quarters(spark, sf_dir).withColumn("lag1", F.lag("n").over(w).cast("double")).withColumn("lag4", F.lag("n", 4).over(w).cast("double")).where("lag4 is not null")
    long = b.unpivot(["o_orderpriority", "q", "n"], ["lag1", "lag4"], "model", "predicted")
    e = F.col("n") - F.col("predicted")
    weights = long.groupBy("o_orderpriority", "model").agg((1 / F.sqrt(F.avg(e * e))).alias("weight"))
    return models.ensemble(long, weights, ["o_orderpriority"], "q", 1.0).select("o_orderpriority", "q", F.round("predicted", 4).alias("predicted"))


@query("mod16_jarque_bera", f"""WITH x AS (SELECT o_orderpriority, n, avg(n) OVER (PARTITION BY o_orderpriority) AS m FROM {QUARTERS}), s AS (SELECT o_orderpriority, count(*) AS n, avg(pow(n - m, 2)) AS m2, avg(pow(n - m, 3)) AS m3, avg(pow(n - m, 4)) AS m4 FROM x GROUP BY 1),
j AS (SELECT o_orderpriority, n, n / 6 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / (m2 * m2) - 3, 2) / 4) AS jb FROM s) SELECT o_orderpriority, n, round(jb, 4) AS jb, round(exp(-jb / 2), 6) AS p FROM j""")
def mod16(spark, sf_dir):
    """MOD-16."""
    return models.jarque_bera(quarters(spark, sf_dir), ["o_orderpriority"], "n")


@query("mod20_trendline", "SELECT p_brand, round(regr_slope(p_retailprice, p_size), 4) AS slope, round(regr_intercept(p_retailprice, p_size), 4) AS intercept, CAST(regr_count(p_retailprice, p_size) AS BIGINT) AS n FROM part GROUP BY 1 HAVING count(*) >= 2")
def mod20(spark, sf_dir):
    """MOD-20."""
    return models.trendline(t(spark, sf_dir, "part"), ["p_brand"], "p_retailprice", "p_size")
