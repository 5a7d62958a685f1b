"""Schemas of the six workforce tables (raw and staged share them)."""

from collections.abc import Mapping

from pyspark.sql import types as T

EMPLOYEE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("birth_date", T.DateType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("hire_date", T.DateType()),
])

TITLE = T.StructType([
    T.StructField("employee_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("from_date", T.DateType()),
    T.StructField("to_date", T.DateType()),
])

SALARY = T.StructType([
    T.StructField("employee_id", T.LongType()),
    T.StructField("amount", T.IntegerType()),
    T.StructField("from_date", T.DateType()),
    T.StructField("to_date", T.DateType()),
])

DEPARTMENT_EMPLOYEE = T.StructType([
    T.StructField("employee_id", T.LongType()),
    T.StructField("department_id", T.LongType()),
    T.StructField("from_date", T.DateType()),
    T.StructField("to_date", T.DateType()),
])

DEPARTMENT_MANAGER = T.StructType([
    T.StructField("employee_id", T.LongType()),
    T.StructField("department_id", T.LongType()),
    T.StructField("from_date", T.DateType()),
    T.StructField("to_date", T.DateType()),
])

DEPARTMENT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("dept_name", T.StringType()),
])

SCHEMAS = {
    "employee": EMPLOYEE,
    "title": TITLE,
    "salary": SALARY,
    "department_employee": DEPARTMENT_EMPLOYEE,
    "department_manager": DEPARTMENT_MANAGER,
    "department": DEPARTMENT,
}

# Columns that hold the same key.
KEY_COLUMNS = (
    (("employee", "id"), *((t, "employee_id") for t in ("title", "salary", "department_employee", "department_manager"))),
    (("department", "id"), ("department_employee", "department_id"), ("department_manager", "department_id")),
)


def negotiated(found: Mapping[str, T.StructType]) -> dict[str, T.StructType]:
    """The declared schemas with each key in the type that its ``found`` columns share:
    LONG if all are integers, else STRING."""
    types = {}
    for columns in KEY_COLUMNS:
        whole = all(isinstance(found[t][c].dataType, T.IntegralType) for t, c in columns)
        types |= {column: T.LongType() if whole else T.StringType() for column in columns}
    return {t: T.StructType([T.StructField(f.name, types.get((t, f.name), f.dataType)) for f in schema])
            for t, schema in SCHEMAS.items()}


# Tables whose rows are validity periods.
SCD_TABLES = ("title", "salary", "department_employee", "department_manager")

# Narrower keys, which repeat where a person has several periods.
PERSON_KEYS = tuple((t, ("employee_id",)) for t in SCD_TABLES)

# Declared unique keys of the staged copies.
UNIQUE_KEYS = (
    ("employee", ("id",)),
    ("department_employee", ("employee_id", "department_id")),
    ("department", ("id",)),
    ("department", ("dept_name",)),
    ("department_manager", ("employee_id", "department_id")),
    ("salary", ("employee_id", "from_date")),
    ("title", ("employee_id", "title", "from_date")),
)
