"""The five raw cohort tables derived from customer, orders, nation and region.

A customer plays the student. Plain arithmetic on keys and balances puts every
kind of dirty value into the tables; the rules are listed in ``FIXTURES.md``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Schemas of the given tables: naming them saves a job per read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


class OrdersCohort:
    """Lazily derived raw tables; each reads only the columns it needs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def _read(self, table: str) -> DataFrame:
        return read_table(self._spark, self._dir, table)

    def _customers(self) -> DataFrame:
        return self._read("customer").selectExpr(
            "*", "c_custkey AS k", "concat('S', cast(c_custkey + 100000 AS string)) AS student_id"
        )

    def _with_orders(self) -> DataFrame:
        """Customers with what their orders say: ``nf``, ``nd`` and ``is_late``.

        All three travel in one array, so that every table has the same aggregate and Spark
        exchanges ``orders`` once for them together.
        """
        urgent = "o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')"
        late = "max(o_orderdate) < timestamp_ntz '2000-11-01 00:00:00'"
        measures = f"array(count_if({urgent}), count(DISTINCT o_orderdate), if({late}, 1L, 0L)) AS m"
        per_customer = self._read("orders").groupBy("o_custkey").agg(F.expr(measures))
        return self._customers().join(per_customer.withColumnRenamed("o_custkey", "k"), "k", "left").selectExpr(
            "*", "cast(m[0] AS int) AS nf", "cast(m[1] AS int) AS nd", "m[2] = 1 AS is_late"
        )

    def students(self) -> DataFrame:
        nation, region = self._read("nation"), self._read("region")
        places = nation.join(region, nation.n_regionkey == region.r_regionkey)
        return (
            self._customers()
            .join(places.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
            .selectExpr(
                "student_id",
                "CASE WHEN k % 33 = 0 THEN NULL WHEN k % 29 = 0 THEN 'Other' "
                "WHEN k % 2 = 0 THEN ' Male ' ELSE 'Female' END AS gender",
                "if(k % 12 = 0, lower(r_name), r_name) AS region",
                "n_name AS school_id",
                "cast(if(k % 50 = 1, 15, 6 + k % 7) AS int) AS grade_level",
                "cast(2014 + k % 10 AS int) AS enrollment_year",
                "lower(c_mktsegment) AS program_type",
            )
        )

    def academic(self) -> DataFrame:
        return self._with_orders().selectExpr(
            "student_id",
            "CASE WHEN k % 20 = 1 THEN NULL WHEN k % 97 = 0 THEN 120D ELSE floor(c_acctbal) / 100 END AS avg_score",
            "if(k % 40 = 3, NULL, nf) AS failed_subjects",
        )

    def attendance(self) -> DataFrame:
        return self._with_orders().selectExpr(
            "student_id",
            "CASE WHEN k % 61 = 5 THEN NULL WHEN k % 60 = 0 THEN 0 ELSE 180 END AS total_days",
            "if(k % 25 = 2, NULL, nd * 14) AS days_present",
        )

    def socio(self) -> DataFrame:
        return self._customers().selectExpr(
            "student_id",
            "CASE WHEN k % 17 = 0 THEN NULL WHEN c_acctbal < 3000 THEN ' Low' "
            "WHEN c_acctbal < 7000 THEN 'Middle' ELSE 'High' END AS family_income_band",
            "CASE k % 23 WHEN 0 THEN NULL WHEN 1 THEN 'Unknown Level' ELSE ' Graduate ' END AS parental_education",
            "CASE k % 7 WHEN 0 THEN 'Yes' WHEN 1 THEN ' YES' WHEN 2 THEN 'true' WHEN 3 THEN NULL ELSE 'No' END "
            "AS access_to_internet",
            "CASE k % 8 WHEN 0 THEN 'Yes' WHEN 1 THEN 'True' ELSE 'False' END AS working_part_time",
            "CASE k % 5 WHEN 0 THEN 'Y' WHEN 1 THEN '1' WHEN 2 THEN 't' ELSE 'False' END AS scholarship_status",
        )

    def retention(self) -> DataFrame:
        return self._with_orders().selectExpr(
            "student_id",
            "if(k % 50 = 7, NULL, is_late) AS dropout_flag",
            "if(k % 3 = 0, NULL, 'Financial Issues') AS dropout_reason",
            "if(k % 4 = 0, 'Dropped', 'Retained') AS retention_status",
        )

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)()
