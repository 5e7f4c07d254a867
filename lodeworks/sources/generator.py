"""A synthetic delivery of two sources, for fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ADMISSIONS, LABS, PATIENTS


def delivery(spark: SparkSession, entities: int = 160, defects: bool = False) -> dict[str, DataFrame]:
    """patients, admissions and lab results as text; per entity one stay, a
    quarter of entities return after ten days.  With ``defects`` each table
    gets one row that breaks a rule."""
    i = F.col("id")
    lakeside = i < entities // 2
    pid = F.when(lakeside, F.concat(F.lit("LG-"), F.lpad(i.cast("string"), 6, "0"))).otherwise(F.concat(F.lit("RS"), F.lpad(i.cast("string"), 5, "0")))
    base = spark.range(entities).withColumn("patient_id", pid)
    patients = base.select("patient_id", F.when(lakeside, "LG").otherwise("RS").alias("source_system"), F.concat(F.lit("Name"), i).alias("first_name"), F.concat(F.lit("Family"), i).alias("last_name"),
                           F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (i * 97 % 20000).cast("int")), "yyyy-MM-dd").alias("date_of_birth"), F.when(i % 2 == 0, "M").otherwise("F").alias("sex"),
                           F.concat(F.lit("080"), F.lpad((i * 7919 % 100000000).cast("string"), 8, "0")).alias("phone"), F.lit("Lagos").alias("state"))
    returns = base.where(i % 4 == 0)
    day = lambda c, n: F.date_format(F.date_add(c, n), "yyyy-MM-dd")
    start = F.date_add(F.lit("2024-01-10").cast("date"), F.when(i % 8 < 4, 0).otherwise(400))

    def stay(df: DataFrame, tag: str, shift: int) -> DataFrame:
        return df.select(F.concat(F.lit(f"{tag}-"), F.lpad(i.cast("string"), 6, "0")).alias("admission_id"), "patient_id", F.when(lakeside, "Lakeside General").otherwise("Riverside Specialist").alias("hospital"),
                         day(start, shift).alias("admit_date"), day(start, shift + 2).alias("discharge_date"), F.element_at(F.array(*map(F.lit, ("I50.9", "E11.9", "J18.9"))), (i % 3 + 1).cast("int")).alias("diagnosis_code"), F.lit("home").alias("discharge_status"))

    admissions = stay(base, "ADM", 0).unionByName(stay(returns, "RET", 12))
    labs = admissions.select(F.concat(F.lit("LAB-"), "admission_id").alias("lab_id"), "admission_id", F.lit("glucose").alias("test_name"), F.lit("5.5").alias("result_value"), F.lit("mmol/L").alias("unit"), F.concat("admit_date", F.lit("T12:00:00")).alias("result_time"))
    out = {"patients": patients.select(*PATIENTS), "admissions": admissions.select(*ADMISSIONS), "lab_results": labs.select(*LABS)}
    if defects:
        bad = {"patients": ["LG-1", "LG", "A", "B", "1990-01-01", "M", "", ""], "admissions": ["ADM-BAD", "nobody", "Lakeside General", "2024-01-01", "2024-01-02", "I50", "home"], "lab_results": ["LAB-BAD", "ADM-000000", "sodium", "1", "mg/dL", "2024-01-10T12:00:00"]}
        out = {k: df.unionByName(spark.createDataFrame([bad[k]], df.schema)) for k, df in out.items()}
    return out
