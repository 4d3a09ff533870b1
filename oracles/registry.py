"""Registered queries: the Spark side (library call on the driver-derived
tables) paired with its DuckDB oracle SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from assurspark.plans import claims
from assurspark.plans.params import (
    ClaimsOutstandingParams, ClaimsReportedParams, ClaimsSettledParams,
)
from assurspark.session import configure
from assurspark.sources.catalog import Tables

from . import claims_sql


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]          # the query over any set of logical tables
    oracle: Callable[[], str] | None              # DuckDB SQL over the driver-derived tables

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(tables(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    configure(spark)
    return Tables.from_driver_data(spark, sf_dir)


def register(name: str, build, oracle_fn=None) -> None:
    QUERIES[name] = Query(build, oracle_fn)


D = dt.datetime

# ----------------------------------------------------------------- reports
_r01 = ClaimsReportedParams(date_from=D(1998, 1, 1), date_to=D(1998, 12, 31))
register("claims_reported",
         lambda t: claims.claims_reported(t, _r01),
         lambda: claims_sql.claims_reported(date_from=_r01.date_from, date_to=_r01.date_to))
_r01d = ClaimsReportedParams(branch="R3", department="N3", product="MA%",
                             date_from=D(1996, 1, 1), date_to=D(1999, 12, 31, 12, 0))
register("claims_reported_department",
         lambda t: claims.claims_reported(t, _r01d),
         lambda: claims_sql.claims_reported(branch="R3", department="N3", product="MA%",
                                            date_from=_r01d.date_from, date_to=_r01d.date_to))
_r01ci = ClaimsReportedParams(branch="r3 ", department="n3", product="ma%", string_compare="ci",
                              date_from=D(1996, 1, 1), date_to=D(1999, 12, 31, 12, 0))
register("claims_reported_case_insensitive",
         lambda t: claims.claims_reported(t, _r01ci),
         lambda: claims_sql.claims_reported(branch="r3 ", department="n3", product="ma%", ci=True,
                                            date_from=_r01ci.date_from, date_to=_r01ci.date_to))
_r02 = ClaimsOutstandingParams(as_at=D(1998, 7, 1), run_ts=D(2002, 1, 1))
register("claims_outstanding",
         lambda t: claims.claims_outstanding(t, _r02),
         lambda: claims_sql.claims_outstanding(as_at=_r02.as_at, run_ts=_r02.run_ts))
_r02d = ClaimsOutstandingParams(department="N7", product="", as_at=D(1999, 3, 15), run_ts=D(2002, 1, 1))
register("claims_outstanding_department",
         lambda t: claims.claims_outstanding(t, _r02d),
         lambda: claims_sql.claims_outstanding(department="N7", product="", as_at=_r02d.as_at,
                                               run_ts=_r02d.run_ts))
_r02f = ClaimsOutstandingParams(branch="R1", department="N6", as_at=D(1999, 3, 15), run_ts=D(2002, 1, 1),
                                fix_arms=True)
register("claims_outstanding_fixed",
         lambda t: claims.claims_outstanding(t, _r02f),
         lambda: claims_sql.claims_outstanding(branch="R1", department="N6", as_at=_r02f.as_at,
                                               run_ts=_r02f.run_ts, fix_arms=True))
_r03 = ClaimsSettledParams(class_code="%", product="%", date_from=D(1997, 1, 1), date_to=D(1998, 12, 31))
register("claims_settled",
         lambda t: claims.claims_settled(t, _r03),
         lambda: claims_sql.claims_settled(class_code="%", product="%", date_from=_r03.date_from,
                                           date_to=_r03.date_to))
_r03f = ClaimsSettledParams(branch="N4", date_from=D(1998, 1, 1), date_to=None, fix_open_end=True)
register("claims_settled_open_end_fixed",
         lambda t: claims.claims_settled(t, _r03f),
         lambda: claims_sql.claims_settled(branch="N4", date_from=_r03f.date_from, date_to=None,
                                           fix_open_end=True))
_r03o = ClaimsSettledParams(branch="N4", date_from=D(1998, 1, 1), date_to=None)
register("claims_settled_open_end",
         lambda t: claims.claims_settled(t, _r03o),
         lambda: claims_sql.claims_settled(branch="N4", date_from=_r03o.date_from, date_to=None))

_r02ci = ClaimsOutstandingParams(branch="r1", department="n6 ", product="ma%", as_at=D(1999, 3, 15),
                                 run_ts=D(2002, 1, 1), fix_arms=True, string_compare="ci")
register("claims_outstanding_case_insensitive",
         lambda t: claims.claims_outstanding(t, _r02ci),
         lambda: claims_sql.claims_outstanding(branch="R1", department="N6", product="MA%", as_at=_r02ci.as_at,
                                               run_ts=_r02ci.run_ts, fix_arms=True, echo=("r1",)))
_r03ci = ClaimsSettledParams(branch="n4 ", product="%", date_from=D(1996, 1, 1), date_to=D(1999, 12, 31), string_compare="ci")
register("claims_settled_case_insensitive",
         lambda t: claims.claims_settled(t, _r03ci),
         lambda: claims_sql.claims_settled(branch="N4", product="%", date_from=_r03ci.date_from, date_to=_r03ci.date_to,
                                           echo=("n4 ",)))

# -------------------------------------------------------- daily production
from assurspark.plans import production  # noqa: E402
from assurspark.plans.params import DailyProductionParams  # noqa: E402

from . import production_sql  # noqa: E402


def _prod(name: str, **kw) -> None:
    params = DailyProductionParams(**kw)
    register(name, lambda t: production.daily_production(t, params),
             lambda: production_sql.daily_production(**kw))


_prod("daily_production_c", basic_date="C", date_from=D(1996, 1, 1), date_to=D(1998, 12, 31))
_prod("daily_production_a", basic_date="A", sysown_id=None, marketer="K01",
      date_from=D(1997, 1, 1), date_to=D(1997, 12, 31))
_prod("daily_production_i", basic_date="I", class_code="MO", date_from=D(1996, 6, 1), date_to=D(1999, 6, 30))
_prod("daily_production_fixed", basic_date="C", branch="DP3", date_from=D(1996, 1, 1), date_to=D(1998, 12, 31),
      certificate_policy_id=None, fix_group_exclusion=True, fix_commission_nulls=True, fix_period_end=True)

_prod("daily_production_unknown_basis", basic_date="X", date_from=D(1996, 1, 1), date_to=D(1998, 12, 31))
_prod("daily_production_certificates", basic_date="C", branch="DP7", date_from=D(1995, 1, 1), date_to=D(2000, 12, 31),
      certificate_policy_id=None)
_production_ci = DailyProductionParams(basic_date="C", branch="dp3 ", class_code="mo", string_compare="ci",
                                       date_from=D(1996, 1, 1), date_to=D(1998, 12, 31))
register("daily_production_case_insensitive", lambda t: production.daily_production(t, _production_ci),
         lambda: production_sql.daily_production(branch="DP3", class_code="MO", date_from=D(1996, 1, 1), date_to=D(1998, 12, 31)))

# ------------------------------------------------- operator-level queries
from .operator_queries import Q as _OPS  # noqa: E402

for _name, (_build, _sql) in _OPS.items():
    register(_name, _build, _sql)
