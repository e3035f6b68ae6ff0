"""Organization and department dimensions.

The job looks up the ids of business keys in stored tables (see ``numbering``). Without such tables an id
is a 64-bit hash of the business key: it needs no lookup and stays the same from run to run. The
unique rule on ``id`` in the table contract exposes two business keys with one hash; another ``salt`` then
gives all keys anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions.text import clean_columns


def surrogate_key(*business_key: Column, salt: int = 0) -> Column:
    """64-bit hash of a business key; each salt gives other hashes."""
    return F.xxhash64(*([F.lit(salt)] if salt else []), *business_key)


def organization_key(code: Column, salt: int = 0) -> Column:
    return F.when(code.isNotNull(), surrogate_key(code, salt=salt))


def department_key(organization_code: Column, code: Column, salt: int = 0) -> Column:
    return F.when(
        organization_code.isNotNull() & code.isNotNull(),
        surrogate_key(organization_code, code, salt=salt),
    )


def with_dimension_codes(cleaned: DataFrame) -> DataFrame:
    """Add ``organization_code`` and ``department_code``, null where the row names no member.

    An organization needs code and name; a department also needs its organization.
    """
    organization = F.when(F.col("organization_name").isNotNull(), F.col("organization_id"))
    department = F.when(
        organization.isNotNull() & F.col("department_name").isNotNull(), F.col("department_id")
    )
    return cleaned.withColumns(
        {"organization_code": organization, "department_code": department}
    )


def _members(raw_employee: DataFrame) -> DataFrame:
    columns = (
        "client_employee_id", "organization_id", "organization_name", "department_id",
        "department_name", "source_file",
    )
    return with_dimension_codes(clean_columns(raw_employee.select(*columns), columns))


def _first_name(name: str) -> Column:
    """Name seen first, in the fixed order of file, employee and name."""
    return F.min_by(F.col(name), F.struct("source_file", "client_employee_id", name))


def organizations(raw_employee: DataFrame, salt: int = 0, ids: DataFrame | None = None) -> DataFrame:
    """One row per organization code; the first name wins. ``ids`` has (id, code) of each."""
    found = (
        _members(raw_employee)
        .filter(F.col("organization_code").isNotNull())
        .groupBy(F.col("organization_code").alias("code"))
        .agg(_first_name("organization_name").alias("name"))
    )
    if ids is not None:
        return found.join(ids, "code").select("id", "code", "name")
    return found.select(organization_key(F.col("code"), salt).alias("id"), "code", "name")


def departments(
    raw_employee: DataFrame,
    salt: int = 0,
    ids: DataFrame | None = None,
    organization_ids: DataFrame | None = None,
) -> DataFrame:
    """One row per department code and organization; the first name wins.

    ``ids`` has (id, organization_code, code) of each, ``organization_ids`` (id, code).
    """
    found = (
        _members(raw_employee)
        .filter(F.col("department_code").isNotNull())
        .groupBy("organization_code", F.col("department_code").alias("code"))
        .agg(_first_name("department_name").alias("name"))
    )
    if ids is not None:
        organization = organization_ids.select(
            F.col("code").alias("organization_code"), F.col("id").alias("organization_id")
        )
        joined = found.join(ids, ["organization_code", "code"]).join(organization, "organization_code")
        return joined.select("id", "code", "name", "organization_id")
    return found.select(
        department_key(F.col("organization_code"), F.col("code"), salt).alias("id"),
        "code",
        "name",
        organization_key(F.col("organization_code"), salt).alias("organization_id"),
    )
