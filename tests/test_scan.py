"""Limits of a target over all objects of a scan."""

import pytest

from concordat.operators import scan


def limits(spark, rows):
    found = scan.findings(spark.createDataFrame(rows, "type string, fqn string, ddl string"), "mysql")
    return sorted(r["code"] for r in found.where("fqn = '(schema)'").collect())


def test_a_role_made_again_is_one_role(spark):
    again = ["CREATE ROLE boss WITH SUPERUSER", 'create role  IF NOT EXISTS "Boss"', "CREATE ROLE [clerk];", None]
    assert limits(spark, [("script", f"a.s{i}", again[i % 4]) for i in range(400)]) == []


@pytest.mark.parametrize("n, code", [(64, []), (65, ["BLOCK-007"])])
def test_roles_of_one_script_count_each(spark, n, code):
    assert limits(spark, [("script", "a.s", "\n".join(f"CREATE ROLE r{i};" for i in range(n)))]) == code
    assert limits(spark, [("script", "a.s", "CREATE ROLE " + ", ".join(f"'r{i}'@'%'" for i in range(n)))]) == code


@pytest.mark.parametrize("n, code", [(32, []), (33, ["BLOCK-008"])])
def test_databases_are_no_links(spark, n, code):
    links = [("script", f"a.l{i}", f"CREATE DATABASE LINK l{i}") for i in range(40)]
    assert limits(spark, [*links, *(("script", f"a.d{i}", f"CREATE DATABASE d{i}") for i in range(n))]) == code
