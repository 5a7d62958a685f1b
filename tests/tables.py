"""Hand-made staged tables for unit tests."""

import datetime as dt

from paytrail.sources import schemas

D = dt.date.fromisoformat
OPEN = dt.date(9999, 1, 1)


def frames(spark, employee=(), title=(), salary=(), department_employee=(),
           department_manager=(), department=()):
    def mk(name, rows):
        fields = schemas.SCHEMAS[name].fieldNames()
        conv = [tuple(D(v) if isinstance(v, str) and len(v) == 10 and v[4] == "-" and
                      f.endswith("date") else v for v, f in zip(r, fields)) for r in rows]
        return spark.createDataFrame(conv, schemas.SCHEMAS[name])
    return {
        "employee": mk("employee", employee),
        "title": mk("title", title),
        "salary": mk("salary", salary),
        "department_employee": mk("department_employee", department_employee),
        "department_manager": mk("department_manager", department_manager),
        "department": mk("department", department),
    }


def golden(spark):
    """One employee (id 1) with three salaries, two titles and two managers in
    one department; repaired dates (FIXTURES.md, section C)."""
    return frames(
        spark,
        employee=[(1, "1990-05-05", "Cy", "Doe", "F", "2018-02-28"),
                  (10, "1970-01-01", "Ann", "Lee", "F", "2010-01-01"),
                  (11, "1975-01-01", "Bo", "Kim", "M", "2010-01-01")],
        title=[(1, "Staff", "2018-02-28", "2019-02-28"),
               (1, "Senior Staff", "2019-02-28", "9999-01-01")],
        salary=[(1, 40000, "2018-02-28", "2019-02-28"),
                (1, 44000, "2019-02-28", "2020-02-28"),
                (1, 43000, "2020-02-28", "9999-01-01")],
        department_employee=[(1, 5, "2018-02-28", "9999-01-01")],
        department_manager=[(10, 5, "2017-01-01", "2020-01-15"),
                            (11, 5, "2020-01-15", "9999-01-01")],
        department=[(5, "Research")],
    )
