"""Calendar queries over the days from the first to the last order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.plans import calendar
from partflow.registry.base import Family
from partflow.registry.fixtures import Inputs
from partflow.sources.readers import date_spine

QUERIES = Family()

# Published Easter Sundays of the years in the tables.
EASTER = {1995: "04-16", 1996: "04-07", 1997: "03-30", 1998: "04-12", 1999: "04-04", 2000: "04-23", 2001: "04-15"}


def _holiday_sql() -> str:
    rows = []
    for year, day in EASTER.items():
        rows += [f"(DATE '{year}-{m:02d}-{d:02d}', '{n}')" for m, d, n in calendar.FIXED_HOLIDAYS]
        rows += [f"(CAST(DATE '{year}-{day}' + INTERVAL ({s}) DAY AS DATE), '{n}')"
                 for s, n in calendar.MOVABLE_HOLIDAYS]
    return f"""SELECT data_feriado, string_agg(nome_feriado, ' / ' ORDER BY nome_feriado) AS nome_feriado
        FROM (VALUES {", ".join(rows)}) AS h(data_feriado, nome_feriado)
        WHERE year(data_feriado) IN (SELECT DISTINCT year(data) FROM fx_sales) GROUP BY data_feriado"""


def _names(position: str, names: tuple[str, ...]) -> str:
    return f"list_extract([{', '.join(repr(n) for n in names)}], {position})"


_WD, _MO = "CAST(isodow(data) AS INTEGER)", "CAST(month(data) AS INTEGER)"
_KI = "CAST(CASE WHEN month(data) >= 4 THEN year(data) - 1923 ELSE year(data) - 1924 END AS INTEGER)"
_CALENDAR = f"""
    SELECT data, CAST(year(data) AS INTEGER) AS ano, {_MO} AS mes, CAST(day(data) AS INTEGER) AS dia, {_WD} AS dia_semana,
      {_names(_WD, calendar.WEEKDAYS_PT)} AS nome_dia_semana_pt, {_names(_WD, calendar.WEEKDAYS_EN)} AS nome_dia_semana_en,
      {_names(_MO, calendar.MONTHS_PT)} AS nome_mes_pt, {_names(_MO, calendar.MONTHS_EN)} AS nome_mes_en,
      left({_names(_MO, calendar.MONTHS_PT)}, 3) AS nome_mes_abrev_pt, left({_names(_MO, calendar.MONTHS_EN)}, 3) AS nome_mes_abrev_en,
      strftime(data, '%Y-%m') AS ano_mes, CAST(week(data) AS INTEGER) AS semana_ano, {_KI} AS ki_numero,
      CAST({_KI} AS VARCHAR) || 'ki' AS ki, isodow(data) >= 6 AS fim_semana, data_feriado IS NOT NULL AS feriado,
      nome_feriado, NOT (isodow(data) >= 6 OR data_feriado IS NOT NULL) AS dia_util
    FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS data
      FROM (SELECT min(data) AS lo, max(data) AS hi FROM fx_sales)) LEFT JOIN ({_holiday_sql()}) ON data = data_feriado"""


def order_days(inputs: Inputs) -> DataFrame:
    """Every day from the first to the last order."""
    first, last = inputs.view("fx_sales").agg(F.min("data"), F.max("data")).first()
    return date_spine(inputs.spark, first, last)


def order_calendar(inputs: Inputs) -> DataFrame:
    days = order_days(inputs)
    years = days.select(F.year("data").alias("ano")).distinct()
    return calendar.describe_days(days, calendar.holidays_of_years(years))


@QUERIES.query(_CALENDAR)
def calendar_dim(inputs: Inputs) -> DataFrame:
    return order_calendar(inputs)


@QUERIES.query(_holiday_sql())
def calendar_holidays(inputs: Inputs) -> DataFrame:
    return calendar.holidays_of_years(order_days(inputs).select(F.year("data").alias("ano")).distinct())


@QUERIES.query(f"""
    SELECT ano, count(*) AS total_dias, count_if(feriado) AS feriados, count_if(fim_semana) AS fins_semana,
      count_if(dia_util) AS dias_uteis,
      CAST(round(CAST(count_if(dia_util) * 100 AS DECIMAL(20,6)) / count(*), 1) AS DOUBLE) AS pct_dias_uteis
    FROM ({_CALENDAR}) GROUP BY ano""")
def calendar_year_summary(inputs: Inputs) -> DataFrame:
    return calendar.calendar_year_summary(order_calendar(inputs)).withColumn(
        "pct_dias_uteis", F.col("pct_dias_uteis").cast("double"))


@QUERIES.query(f"""
    SELECT count(*) AS total_registros, min(data) AS data_inicio, max(data) AS data_fim, count(DISTINCT ano) AS qtd_anos,
      count_if(feriado) AS total_feriados, count_if(fim_semana) AS total_fins_semana, count_if(dia_util) AS total_dias_uteis
    FROM ({_CALENDAR})""")
def calendar_summary(inputs: Inputs) -> DataFrame:
    return calendar.calendar_summary(order_calendar(inputs))


_CITY = "Aniversário da cidade"


@QUERIES.query(f"""
    SELECT * REPLACE (
      CASE WHEN month(data) = 4 THEN NULL WHEN day(data) = 25 THEN concat_ws(' / ', nome_feriado, '{_CITY}')
        ELSE nome_feriado END AS nome_feriado,
      CASE WHEN month(data) = 4 THEN false ELSE feriado OR day(data) = 25 END AS feriado,
      CASE WHEN month(data) = 4 THEN NOT fim_semana ELSE dia_util AND day(data) <> 25 END AS dia_util)
    FROM ({_CALENDAR})""")
def holiday_overrides(inputs: Inputs) -> DataFrame:
    days = order_days(inputs)
    include = days.where(F.dayofmonth("data") == 25).withColumn("nome", F.lit(_CITY))
    exclude = days.where(F.month("data") == 4)
    return calendar.apply_holiday_overrides(order_calendar(inputs), include, exclude)


_MONTH_FLAGS = "SELECT ano_mes, count_if(dia_util) AS dias_uteis FROM ({c}) GROUP BY ano_mes"


@QUERIES.query(_MONTH_FLAGS.format(c=_CALENDAR))
def count_where(inputs: Inputs) -> DataFrame:
    from partflow.operators.aggregate import count_where as counted

    return counted(order_calendar(inputs), ["ano_mes"], dias_uteis=F.col("dia_util"))
