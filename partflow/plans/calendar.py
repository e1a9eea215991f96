"""Calendar dimension with national holidays and fiscal years."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.functions.dates import easter, fiscal_label, fiscal_number, iso_weekday
from partflow.functions.labels import MONTHS_EN, MONTHS_PT, WEEKDAYS_EN, WEEKDAYS_PT, name_at
from partflow.operators.aggregate import joined_names
from partflow.sources.readers import date_spine

CALENDAR_START, CALENDAR_END = date(2010, 1, 1), date(2030, 12, 31)

# National holidays by month and day, and by days from Easter Sunday.
FIXED_HOLIDAYS = (
    (1, 1, "Confraternização Universal"),
    (4, 21, "Tiradentes"),
    (5, 1, "Dia do Trabalho"),
    (9, 7, "Independência do Brasil"),
    (10, 12, "Nossa Senhora Aparecida"),
    (11, 2, "Finados"),
    (11, 15, "Proclamação da República"),
    (12, 25, "Natal"),
)
MOVABLE_HOLIDAYS = (
    (-48, "Carnaval (Segunda)"),
    (-47, "Carnaval (Terça)"),
    (-2, "Sexta-feira Santa"),
    (60, "Corpus Christi"),
)

CALENDAR_COLUMNS = (
    "data", "ano", "mes", "dia", "dia_semana", "nome_dia_semana_pt", "nome_dia_semana_en",
    "nome_mes_pt", "nome_mes_en", "nome_mes_abrev_pt", "nome_mes_abrev_en", "ano_mes",
    "semana_ano", "ki_numero", "ki", "fim_semana", "feriado", "nome_feriado", "dia_util",
)


def holidays_of_years(years: DataFrame, year: str = "ano") -> DataFrame:
    """One row per holiday date of the given years; names of one date are joined."""
    y = F.col(year)
    days = [F.struct(F.make_date(y, F.lit(m), F.lit(d)).alias("data_feriado"),
                     F.lit(name).alias("nome_feriado")) for m, d, name in FIXED_HOLIDAYS]
    days += [F.struct(F.date_add(easter(y), shift).alias("data_feriado"),
                      F.lit(name).alias("nome_feriado")) for shift, name in MOVABLE_HOLIDAYS]
    listed = years.select(F.explode(F.array(*days)).alias("h")).select("h.*")
    return joined_names(listed, ["data_feriado"], "nome_feriado")


def calendar_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("ano"))
    return holidays_of_years(years)


def describe_days(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """The calendar columns for a column ``data`` of distinct days."""
    day = F.col("data")
    weekday, month = iso_weekday(day), F.month(day)
    joined = days.join(holidays, F.col("data") == F.col("data_feriado"), "left")
    weekend, holiday = weekday >= 6, F.col("data_feriado").isNotNull()
    return joined.withColumns({
        "ano": F.year(day), "mes": month, "dia": F.dayofmonth(day), "dia_semana": weekday,
        "nome_dia_semana_pt": name_at(weekday, WEEKDAYS_PT),
        "nome_dia_semana_en": name_at(weekday, WEEKDAYS_EN),
        "nome_mes_pt": name_at(month, MONTHS_PT),
        "nome_mes_en": name_at(month, MONTHS_EN),
        "nome_mes_abrev_pt": F.substring(name_at(month, MONTHS_PT), 1, 3),
        "nome_mes_abrev_en": F.substring(name_at(month, MONTHS_EN), 1, 3),
        "ano_mes": F.date_format(day, "yyyy-MM"), "semana_ano": F.weekofyear(day),
        "ki_numero": fiscal_number(day), "ki": fiscal_label(day),
        "fim_semana": weekend, "feriado": holiday, "dia_util": ~(weekend | holiday),
    }).select(*CALENDAR_COLUMNS)


def calendar_dim(spark: SparkSession, start: date = CALENDAR_START,
                 end: date = CALENDAR_END) -> DataFrame:
    holidays = calendar_holidays(spark, start.year, end.year)
    return describe_days(date_spine(spark, start, end), holidays)


def apply_holiday_overrides(calendar: DataFrame, include: DataFrame | None = None,
                            exclude: DataFrame | None = None) -> DataFrame:
    """Adds holidays (``data``, ``nome``) and removes others (``data``).

    An added name is appended to one that is there; a removed day is a working day again
    unless it falls on a weekend. Removal comes last.
    """
    if include is not None:
        names = joined_names(include.select("data", "nome"), ["data"], "nome")
        hit = F.col("_new").isNotNull()
        calendar = calendar.join(names.withColumnRenamed("nome", "_new"), "data", "left").withColumns({
            "nome_feriado": F.when(hit, F.concat_ws(" / ", "nome_feriado", "_new"))
            .otherwise(F.col("nome_feriado")),
            "feriado": F.col("feriado") | hit,
            "dia_util": F.col("dia_util") & ~hit,
        }).drop("_new")
    if exclude is not None:
        days = exclude.select("data").distinct().withColumn("_out", F.lit(True))
        out = F.col("_out").isNotNull()
        calendar = calendar.join(days, "data", "left").withColumns({
            "nome_feriado": F.when(~out, F.col("nome_feriado")),
            "feriado": F.col("feriado") & ~out,
            "dia_util": F.when(out, ~F.col("fim_semana")).otherwise(F.col("dia_util")),
        }).drop("_out")
    return calendar.select(*CALENDAR_COLUMNS)


def calendar_summary(calendar: DataFrame) -> DataFrame:
    return calendar.agg(
        F.count(F.lit(1)).alias("total_registros"), F.min("data").alias("data_inicio"),
        F.max("data").alias("data_fim"), F.count_distinct("ano").alias("qtd_anos"),
        F.count_if("feriado").alias("total_feriados"),
        F.count_if("fim_semana").alias("total_fins_semana"),
        F.count_if("dia_util").alias("total_dias_uteis"))


def calendar_year_summary(calendar: DataFrame) -> DataFrame:
    working = F.count_if("dia_util")
    return calendar.groupBy("ano").agg(
        F.count(F.lit(1)).alias("total_dias"), F.count_if("feriado").alias("feriados"),
        F.count_if("fim_semana").alias("fins_semana"), working.alias("dias_uteis"),
        F.round(working * 100.0 / F.count(F.lit(1)), 1).alias("pct_dias_uteis"))
