"""Filters, readable names and PCA."""

from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txnscope.catalog.registry import query
from txnscope.functions.text import readable_names
from txnscope.sources import txn_orders

FILTER_SQL = """
SELECT 'amount_over_100k' AS mask, count(*) AS rows FROM txn_orders WHERE amount > 100000
UNION ALL SELECT 'months_1996', count(*) FROM txn_orders WHERE strftime(ts, '%Y-%m') BETWEEN '1996-01' AND '1996-12'
UNION ALL SELECT 'high_priority', count(*) FROM txn_orders WHERE category IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT 'combined', count(*) FROM txn_orders
  WHERE (amount > 100000 AND category IN ('1-URGENT', '2-HIGH')) OR (segment = 'BUILDING' AND NOT y = 1)
"""


@query("c1_filters_and_masks", FILTER_SQL)
def filters(spark, sf_dir):
    """Filters by comparison, month range, set membership and mask algebra."""
    t = txn_orders(spark, sf_dir)
    big = F.col("amount") > 100000
    months = F.date_format("ts", "yyyy-MM").between("1996-01", "1996-12")
    high = F.col("category").isin("1-URGENT", "2-HIGH")
    combined = (big & high) | ((F.col("segment") == "BUILDING") & ~(F.col("y") == 1))
    parts = [t.where(c).agg(F.count(F.lit(1)).alias("rows")).withColumn("mask", F.lit(n))
             for n, c in (("amount_over_100k", big), ("months_1996", months), ("high_priority", high),
                          ("combined", combined))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# fixed values: readable names of the model columns and of the one-hot prefix
NAMES = {"amount": "Importe", "prior_count": "Operaciones previas del cliente",
         "gap_hours": "Horas desde la operación anterior", "key_te": "Tasa histórica del cliente",
         "is_outlier": "Importe atípico"}
PREFIXES = {"cat_": "Prioridad"}

NAMES_SQL = """
WITH v AS (SELECT DISTINCT 'cat_' || category AS variable FROM txn_orders
           UNION SELECT unnest(['amount', 'prior_count', 'gap_hours', 'key_te', 'is_outlier']))
SELECT variable, CASE variable WHEN 'amount' THEN 'Importe' WHEN 'prior_count' THEN 'Operaciones previas del cliente'
                               WHEN 'gap_hours' THEN 'Horas desde la operación anterior'
                               WHEN 'key_te' THEN 'Tasa histórica del cliente' WHEN 'is_outlier' THEN 'Importe atípico'
                               ELSE CASE WHEN starts_with(variable, 'cat_') THEN 'Prioridad: ' || substr(variable, 5)
                                         ELSE variable END END AS readable
FROM v
"""


@query("b22_readable_feature_names", NAMES_SQL)
def names(spark, sf_dir):
    """Readable names of the model columns (exact map, then prefix rules); the
    one-hot columns come from the categories present in the data."""
    t = txn_orders(spark, sf_dir)
    v = t.select(F.concat(F.lit("cat_"), "category").alias("variable")).distinct() \
        .unionByName(spark.createDataFrame([(k,) for k in NAMES], "variable string")).distinct()
    return v.select("variable", readable_names("variable", NAMES, PREFIXES).alias("readable"))


@query("j8_pca_two_components")
def pca(spark, sf_dir):
    """Two principal components of a standardised numeric subset, fitted on the train
    period only; explained variance and the component means on later rows."""
    t = txn_orders(spark, sf_dir).withColumn("region", F.col("region").cast("double")) \
        .withColumn("priority", F.substring("category", 1, 1).cast("double"))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    cols = ["amount", "region", "priority", "y"]
    va = VectorAssembler(inputCols=cols, outputCol="raw")
    tr, te = va.transform(t.where(F.col("ts") < cut)), va.transform(t.where(F.col("ts") >= cut))
    sc = StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True).fit(tr)
    p = PCA(k=2, inputCol="z", outputCol="pc").fit(sc.transform(tr))
    out = p.transform(sc.transform(te)).select(vector_to_array("pc").alias("pc"))
    ev = [float(v) for v in p.explainedVariance.toArray()]
    m = out.agg(F.avg(F.col("pc")[0]).alias("pc1_mean"), F.avg(F.col("pc")[1]).alias("pc2_mean"),
                F.count(F.lit(1)).alias("rows"))
    return m.withColumn("explained_variance_1", F.lit(ev[0])).withColumn("explained_variance_2", F.lit(ev[1]))
