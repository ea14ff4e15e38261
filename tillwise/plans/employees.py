"""Employee enrichment: employees left-joined to departments, with a full name and a tax column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.numbers import one_percent
from tillwise.functions.text import dotted_name
from tillwise.operators.joins import skew_join
from tillwise.sinks.tables import replace_table, truncate_table
from tillwise.sources.files import read_csv
from tillwise.sources.schemas import DEPARTMENTS, EMPLOYEES


def enrich(employees: DataFrame, departments: DataFrame) -> DataFrame:
    """Employees without a department keep nulls; employees without an id are dropped."""
    known = employees.filter(F.col("EmployeeID").isNotNull()).withColumnRenamed("DepartmentID", "_dep")
    joined = skew_join(known, departments, ("_dep", "DepartmentID"), "left", spread=["EmployeeID"])
    return joined.select(
        "EmployeeID",
        dotted_name("FirstName", "LastName").alias("FullName"),
        "Email",
        "Salary",
        "JoinDate",
        "DepartmentID",
        "DepartmentName",
        one_percent(F.col("Salary")).alias("EmpTax"),
    )


def load_employees(
    spark: SparkSession,
    employees_csv: str,
    departments_csv: str,
    location: str,
    emp_table: str,
    dep_table: str,
    out_table: str,
    header: bool = False,
) -> None:
    """Load both files into raw tables, then replace the enriched table."""
    loads = ((employees_csv, emp_table, EMPLOYEES, "emp"), (departments_csv, dep_table, DEPARTMENTS, "dep"))
    for path, table, schema, folder in loads:
        truncate_table(read_csv(spark, path, schema, header=header), table, schema, f"{location}/{folder}")
    replace_table(enrich(spark.table(emp_table), spark.table(dep_table)), out_table, f"{location}/out")
