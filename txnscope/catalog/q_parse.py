"""Parsing, typing and projection queries."""

from pyspark.sql import functions as F

from txnscope.catalog.registry import query
from txnscope.functions import calendar as C
from txnscope.functions import parse as P
from txnscope.functions import rules as R
from txnscope.functions import text as T
from txnscope.operators import history as H
from txnscope.sources import load, scored_lines, txn_events
from txnscope.sources.raw import RAW_TRANSACTIONS_SQL, raw_transactions

RAW = f"WITH raw AS ({RAW_TRANSACTIONS_SQL})"

PARSE_SQL = RAW + """
SELECT txn_id, r6(TRY_CAST(replace(amount_txt, ',', '.') AS DOUBLE)) AS amount,
       strftime(try_strptime(date_txt, '%y%m%d'), '%Y-%m-%d') AS trx_date,
       strftime(try_strptime(birth_txt, '%d/%m/%Y'), '%Y-%m-%d') AS birth_date,
       CASE WHEN try_strptime(substr(lpad(time_txt, 8, '0'), 1, 6), '%H%M%S') IS NOT NULL
            THEN substr(lpad(time_txt, 8, '0'), 1, 6) END AS trx_time,
       strftime(try_strptime(strftime(try_strptime(date_txt, '%y%m%d'), '%Y-%m-%d') || ' ' ||
                substr(lpad(time_txt, 8, '0'), 1, 6), '%Y-%m-%d %H%M%S'), '%Y-%m-%d %H:%M:%S') AS trx_ts
FROM raw
"""


@query("b1_b5_parse_raw_text", PARSE_SQL)
def parse_raw(spark, sf_dir):
    """Decimal comma, yyMMdd, dd/MM/yyyy, padded hhmmss (bad → null), timestamp."""
    r = raw_transactions(spark, sf_dir)
    d = P.date_yymmdd("date_txt")
    t = P.time_hhmmss("time_txt")
    return r.select(
        "txn_id", P.decimal_comma("amount_txt").alias("amount"),
        F.date_format(d, "yyyy-MM-dd").alias("trx_date"),
        F.date_format(P.date_ddmmyyyy("birth_txt"), "yyyy-MM-dd").alias("birth_date"),
        t.alias("trx_time"),
        F.date_format(P.event_timestamp(d, t), "yyyy-MM-dd HH:mm:ss").alias("trx_ts"),
    )


CODES_SQL = RAW + """
SELECT txn_id, CASE WHEN label_txt = 'SI' THEN 1 WHEN label_txt = 'NO' THEN 0 END AS label,
       CAST(amount > 50 AS INT) AS high_amount,
       CASE WHEN chip_txt = '0' THEN 'N' ELSE chip_txt END AS chip,
       coalesce(city, 'SIN_TERMINAL') AS city,
       coalesce(CASE WHEN terminal IN (0, 1, 2, 4, 12) THEN 'Presencial'
                     WHEN terminal BETWEEN 0 AND 12 THEN 'No presencial' END, 'No presencial') AS presence,
       CAST(currency = 2 AS INT) AS is_dollar
FROM raw
"""


@query("b6_b11_labels_codes_flags", CODES_SQL)
def codes(spark, sf_dir):
    """B6 label literals, B7 bool→int, B8 recode, B9 fill, B10 code map (T9 default), B11 flag."""
    r = raw_transactions(spark, sf_dir).withColumn("high_amount", F.col("amount") > 50)
    r = P.bools_to_int(r, ["high_amount"])
    return r.select(
        "txn_id", P.binary_label("label_txt").alias("label"), "high_amount",
        P.recode("chip_txt", {"0": "N"}).alias("chip"),
        P.fill_literal("city", R.NO_TERMINAL).alias("city"),
        R.presence("terminal", default="No presencial").alias("presence"),
        R.eq_flag("currency", R.DOLLAR_CODE).alias("is_dollar"),
    )


CAL_SQL = RAW + """
SELECT txn_id, CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) >= 6 AS INT) AS weekend,
       ['Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado', 'Domingo'][isodow(ts)] AS weekday_name,
       CAST(isodow(ts) - 1 AS INT) AS weekday_num, CAST(dayofmonth(ts) AS INT) AS day_of_month,
       strftime(ts, '%Y-%m') AS period,
       CAST(year(ts) AS VARCHAR) || CASE WHEN month(ts) <= 6 THEN '-H1' ELSE '-H2' END AS half_year,
       CASE WHEN hour(ts) < 6 THEN 'Madrugada (00-06)' WHEN hour(ts) < 12 THEN 'Mañana (06-12)'
            WHEN hour(ts) < 15 THEN 'Mediodía (12-15)' WHEN hour(ts) < 19 THEN 'Tarde (15-19)'
            ELSE 'Noche (19-24)' END AS band5,
       CASE WHEN hour(ts) < 6 THEN 'madrugada' WHEN hour(ts) < 12 THEN 'manana'
            WHEN hour(ts) < 18 THEN 'tarde' ELSE 'noche' END AS band4,
       CAST(floor(date_diff('day', CAST(strptime(birth_txt, '%d/%m/%Y') AS DATE), DATE '2025-01-01') / 365) AS INT) AS age
FROM raw
"""


@query("b12_b16_calendar_features", CAL_SQL)
def calendar(spark, sf_dir):
    """B12 hour, B13 weekend, B14 weekday/period/half-year, B15 bands, B16 age."""
    r = raw_transactions(spark, sf_dir)
    return r.select(
        "txn_id", C.hour_of_day("ts").alias("hour"), C.weekend_flag("ts").alias("weekend"),
        C.weekday_name("ts").alias("weekday_name"), C.weekday_mon0("ts").alias("weekday_num"),
        F.dayofmonth("ts").alias("day_of_month"), C.month_period("ts").alias("period"),
        C.half_year("ts").alias("half_year"),
        C.band(C.hour_of_day("ts"), C.FIVE_BANDS).alias("band5"),
        C.band(C.hour_of_day("ts"), C.FOUR_BANDS).alias("band4"),
        C.age_years(P.date_ddmmyyyy("birth_txt")).alias("age"),
    )


NORM_SQL = f"""
SELECT doc_id, md5(t) AS text_md5, CAST(length(t) AS BIGINT) AS n_chars_norm FROM (
  SELECT doc_id, translate(upper(replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), 'ß', 'SS')),
                           '{T.ACCENTED}', '{T.UNACCENTED}') AS t
  FROM documents)
"""


@query("b17_normalize_text", NORM_SQL)
def normalize(spark, sf_dir):
    """Trim, upper, strip accents over whole documents (md5 + length)."""
    d = load(spark, sf_dir, "documents")
    t = T.normalize_text("text")
    return d.select("doc_id", F.md5(t).alias("text_md5"),
                    F.length(t).cast("long").alias("n_chars_norm"))


TRUNC_SQL = """
SELECT p_partkey, CASE WHEN length(p_name) > 20 THEN rtrim(substr(p_name, 1, 20)) || '...'
                       ELSE p_name END AS label
FROM part
"""


@query("b18_truncate_label", TRUNC_SQL)
def truncate(spark, sf_dir):
    """Label cut to 20 characters with an ellipsis."""
    p = load(spark, sf_dir, "part")
    return p.select("p_partkey", T.truncate_label("p_name", 20).alias("label"))


CYCLIC_SQL = """
SELECT txn_id, r6(ln(1 + amount)) AS log_amount,
       r6(sin(hour(ts) * (2 * pi() / 24))) AS hour_sin, r6(cos(hour(ts) * (2 * pi() / 24))) AS hour_cos,
       r6(sin((isodow(ts) - 1) * (2 * pi() / 7))) AS wd_sin, r6(cos((isodow(ts) - 1) * (2 * pi() / 7))) AS wd_cos
FROM txn_events
"""


@query("b19_log_and_cyclic", CYCLIC_SQL)
def cyclic(spark, sf_dir):
    """log1p amount, sin/cos of hour and weekday."""
    e = txn_events(spark, sf_dir)
    hs, hc = C.cyclic(F.hour("ts"), 24)
    ws, wc = C.cyclic(F.weekday("ts"), 7)
    return e.select("txn_id", C.log_amount("amount").alias("log_amount"), hs.alias("hour_sin"),
                    hc.alias("hour_cos"), ws.alias("wd_sin"), wc.alias("wd_cos"))


POSTAL_SQL = """
SELECT c_custkey, CAST(floor(CAST(abs(c_acctbal) AS INT) / 1000) AS INT) AS postal_region,
       CAST(abs(c_acctbal) AS INT) BETWEEN 1000 AND 9999 AS postal_in_range
FROM customer
"""


@query("b20_postal_region", POSTAL_SQL)
def postal(spark, sf_dir):
    """First digit of a postal code and range flag (code derived from balance)."""
    c = load(spark, sf_dir, "customer").withColumn("postal", F.abs("c_acctbal").cast("int"))
    reg, ok = R.postal_region("postal")
    return c.select("c_custkey", reg.alias("postal_region"), ok.alias("postal_in_range"))


def _contract_rules():
    return {
        "missing_client": F.col("client_id").isNull(),
        "missing_ts": F.col("ts").isNull(),
        "amount_negative": F.col("amount_in") < 0,
        "terminal_out_of_range": ~F.col("terminal").between(0, 12),
        "sex_unknown": ~F.col("sex").isin("F", "M"),
    }


CONTRACT_SQL = RAW + """
SELECT txn_id, reasons = '' AS valid, reasons FROM (
  SELECT txn_id, concat_ws(',',
           CASE WHEN client_id IS NULL THEN 'missing_client' END,
           CASE WHEN ts IS NULL THEN 'missing_ts' END,
           CASE WHEN amount - 5 < 0 THEN 'amount_negative' END,
           CASE WHEN NOT (terminal BETWEEN 0 AND 12) THEN 'terminal_out_of_range' END,
           CASE WHEN sex NOT IN ('F', 'M') THEN 'sex_unknown' END) AS reasons
  FROM raw)
"""


@query("b21_input_contract", CONTRACT_SQL)
def contract(spark, sf_dir):
    """Required fields, amount >= 0, terminal in 0..12, known sex; reasons per row."""
    r = raw_transactions(spark, sf_dir).withColumn("amount_in", F.col("amount") - 5)
    x = r.withColumn("_r", R.contract_reasons(_contract_rules()))
    return x.select("txn_id", (F.size("_r") == 0).alias("valid"),
                    F.array_join("_r", ",").alias("reasons"))


CARD_SQL = """
WITH h AS (
  SELECT *, abs(CASE WHEN sd > 0 THEN greatest(-10.0, least(10.0, (amount - mu) / sd)) ELSE 0.0 END) AS z_abs
  FROM (SELECT txn_id, amount, code, ts,
               (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 3600000000.0 AS gap_hours,
               coalesce(avg(amount) OVER wp, amount) AS mu, coalesce(stddev_samp(amount) OVER wp, 0.0) AS sd
        FROM txn_events
        WINDOW w AS (PARTITION BY client_id ORDER BY ts, txn_id),
               wp AS (PARTITION BY client_id ORDER BY ts, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
SELECT txn_id,
       CASE WHEN amount > 50 THEN 'US$ ' ELSE '$ ' END || translate(format('{:,.2f}', amount), ',.', '.,') AS amount_text,
       CASE WHEN CAST(trunc(code / 7) AS INT) IN (0, 1, 2, 4, 12) THEN 'Presencial' ELSE 'No presencial' END AS channel,
       CASE WHEN gap_hours < 1 / 60 THEN 'menos de 1 minuto'
            WHEN gap_hours < 1 THEN format('{:.0f}', gap_hours * 60) || ' minutos'
            ELSE format('{:.1f}', gap_hours) || ' horas' END AS gap_text,
       format('{:.1f}', z_abs) || ' desvíos estándar' AS deviation_text
FROM h WHERE z_abs >= 3
"""


@query("b23_alert_card", CARD_SQL)
def card(spark, sf_dir):
    """Alert card (money text, channel, gap in words, deviation) for |z| >= 3 rows."""
    e = txn_events(spark, sf_dir)
    h = H.history_features(e).where(F.col("z_amount_abs") >= 3)
    dollars = (F.col("amount") > 50).cast("int")
    return h.select(
        "txn_id", R.money_text("amount", dollars).alias("amount_text"),
        R.presence((F.col("code") / 7).cast("int"), "No presencial").alias("channel"),
        R.gap_words("gap_hours").alias("gap_text"),
        F.concat(F.format_string("%.1f", F.col("z_amount_abs")), F.lit(" desvíos estándar"))
        .alias("deviation_text"),
    )


POLICY_SQL = """
SELECT action, CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS positives
FROM (SELECT y, CASE WHEN score_i / 100.0 >= 0.6 THEN 'review' ELSE 'approve' END AS action FROM scored_lines)
GROUP BY action
"""


@query("b24_alert_policy", POLICY_SQL)
def policy(spark, sf_dir):
    """Review / approve by threshold; counts per action."""
    s = scored_lines(spark, sf_dir).withColumn(
        "action", R.alert_action(F.col("score_i") / 100.0, 0.6))
    return s.groupBy("action").agg(F.count(F.lit(1)).alias("n"),
                                   F.sum("y").cast("long").alias("positives"))
