"""The cleaning run over all tables of a layer (B13, C1, C2, C4, D15, D26, D27, C8, H3 together).

A run is a set of table specifications.  Their foreign keys give the order: a table is cleaned after
its parents, and each cleaned table is written once to the shared folder with its audit trail, so that children, key sets
and reports read it instead of planning it again.  The distinct keys of a parent exist once for each phase
(before, after) and serve both the repair of broken keys and the consistency rules.

When empty rows of a table may go (C3), the rows of its child that point at them go too: the plan hands on
a reduced child, which is the child's input from there on; nothing is changed in place.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import TableRules, domain_rules
from ..operators import dqa
from ..session import materialize
from .cleaning import CleaningPlan, table_counts
from .contract import SchemaContract


@dataclass(frozen=True)
class EmptyRows:
    """What to do with rows whose ``columns`` are all null: asked of the child that points at them."""
    columns: Sequence[str]
    child: str
    child_fk: str
    cancelled_col: str
    group_col: str
    date_col: str
    hour_col: str


@dataclass(frozen=True)
class TableSpec:
    """Cleaning of one table, in the order of the fields."""
    pk: str
    upper: Sequence[str] = ()
    title: Sequence[str] = ()
    dates: Sequence[str] = ()
    empty_rows: EmptyRows | None = None
    unique: Sequence[str] = ()                                # natural key; then the key is numbered anew
    ranges: Sequence[tuple[str, float | None, float | None]] = ()
    repairs: Callable[[CleaningPlan], object] | None = None   # the table's own rules
    fks: Sequence[tuple[str, str, str]] = ()                  # (column, parent, parent's column)
    weather_link: str | None = None                           # parent of the natural-key look-up
    winsorize: Sequence[str] = ()
    bounds: tuple[float, float] = (0.0, 1.0)

    def parents(self) -> list[str]:
        return list(dict.fromkeys([p for _, p, _ in self.fks] + ([self.weather_link] if self.weather_link else [])))


def _weather_repairs(plan: CleaningPlan):
    plan.impute_numeric_nulls_by_group_median("visibility", "origin_airport")
    plan.fix_dew_point().fix_wind_gust().fix_cloud_cover_consistency()


def _aircraft_repairs(plan: CleaningPlan):
    plan.flag_invalid_pattern("tail_num")
    plan.fix_invalid_to_null("manufacturer", MANUFACTURERS)
    plan.flag_invalid_pattern("icao_type", ICAO_TYPE, "fix_invalid_pattern")


# Measures of an observation, allowed manufacturers, form of an aircraft type, and the rules of the seven tables.
WEATHER_MEASURES = ["wind_dir", "wind_spd", "wind_gust", "visibility", "temperature", "dew_point", "rel_humidity", "altimeter",
                    "lowest_cloud_layer", "n_cloud_layer", "low_level_cloud", "mid_level_cloud", "high_level_cloud", "cloud_cover"]
MANUFACTURERS = ["Airbus", "Boeing", "Bombardier", "Embraer", "Unknown"]
ICAO_TYPE = r"^([A-Z0-9]{2,4})$"
SPECS: dict[str, TableSpec] = {
    "Active_Weather": TableSpec(pk="status"),
    "Cancellation": TableSpec(pk="status", title=["cancellation_reason"]),
    "Carriers": TableSpec(pk="code", upper=["code"], title=["description"]),
    "Stations": TableSpec(pk="airport", upper=["airport", "airport_state_code", "icao", "iata", "faa", "mesonet_station"],
                          title=["display_airport_name", "display_airport_city_name_full", "airport_state_name"],
                          ranges=[("elevation", -1500, None)]),
    "Aircrafts": TableSpec(pk="tail_num", upper=["tail_num", "icao_type"], title=["manufacturer"], repairs=_aircraft_repairs),
    "Weather_Observations": TableSpec(
        pk="obs_id", upper=["origin_airport"], dates=["obs_date"],
        empty_rows=EmptyRows(WEATHER_MEASURES, "Flights", "weather_observation_id", "cancelled", "origin_airport", "obs_date", "obs_hour"),
        unique=["origin_airport", "obs_date", "obs_hour"],
        ranges=[("rel_humidity", 0, 100), ("altimeter", 25.0, 35.0), ("visibility", 0.0, 20.0)], repairs=_weather_repairs,
        fks=[("origin_airport", "Stations", "airport"), ("active_weather_status", "Active_Weather", "status")]),
    "Flights": TableSpec(
        pk="flight_id", upper=["origin", "dest", "op_unique_carrier", "mkt_unique_carrier", "tail_num"], dates=["fl_date"],
        repairs=lambda plan: plan.fix_cancelled_air_time(),
        fks=[("origin", "Stations", "airport"), ("dest", "Stations", "airport"), ("tail_num", "Aircrafts", "tail_num"),
             ("mkt_unique_carrier", "Carriers", "code"), ("op_unique_carrier", "Carriers", "code"), ("cancelled", "Cancellation", "status")],
        weather_link="Weather_Observations", winsorize=["taxi_out", "air_time"], bounds=(0.0, 0.99)),
}


class CleaningRun:
    """Cleans the given tables (those that are absent are skipped, and with them the checks against them)."""

    def __init__(self, tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec] = SPECS,
                 rules: Mapping[str, TableRules] | None = None, as_of: str = "2024-02-01"):
        self.raw = dict(tables)
        self.specs = {name: s for name, s in specs.items() if name in self.raw}
        self.rules = domain_rules() if rules is None else dict(rules)
        self.as_of = as_of
        self._plans: dict[str, CleaningPlan] = {}
        self._keys: dict[tuple, DataFrame] = {}

    # -------------------------------------------------------------- order
    def order(self) -> list[str]:
        """Tables, parents before children; a table that drops empty rows comes before their child."""
        needs = {name: {p for p in s.parents() if p in self.specs and p != name} for name, s in self.specs.items()}
        for name, s in self.specs.items():
            if s.empty_rows and s.empty_rows.child in needs:
                needs[s.empty_rows.child].add(name)
        out: list[str] = []
        while len(out) < len(needs):
            ready = [n for n in needs if n not in out and needs[n] <= set(out)]
            if not ready:
                raise ValueError(f"tables that need each other: {sorted(set(needs) - set(out))}")
            out += ready
        return out

    # -------------------------------------------------------------- tables
    def source(self, name: str) -> DataFrame:
        """Input of a table's cleaning: its raw rows without those whose parent row was dropped."""
        for owner, s in self.specs.items():
            if s.empty_rows and s.empty_rows.child == name and owner != name:
                reduced = self.plan(owner).flights
                return self.raw[name] if reduced is None else reduced
        return self.raw[name]

    def keys(self, phase: str, parent: str, key: str) -> DataFrame:
        """Distinct non-null keys of a parent, raw ("before") or clean ("after"), written once."""
        at = (phase, parent, key)
        if at not in self._keys:
            table = self.raw[parent] if phase == "before" else self.clean(parent)
            self._keys[at] = materialize(table.where(F.col(key).isNotNull()).select(key).distinct(), "cleaning-keys")
        return self._keys[at]

    def plan(self, name: str) -> CleaningPlan:
        """The table's cleaning with its audit trail, written; parents are cleaned first."""
        if name not in self._plans:
            spec, p = self.specs[name], CleaningPlan(self.source(name), name, pk=self.specs[name].pk)
            if spec.upper:
                p.standardize_strings(spec.upper, strip=True, upper=True)
            if spec.title:
                p.standardize_strings(spec.title, strip=True, title_case=True)
            for c in spec.dates:
                p.parse_dates(c)
            p.flights = None
            if e := spec.empty_rows:
                p.df = materialize(p.df, f"cleaning-{name.lower()}")  # read for the decision, the rows kept and the rows dropped
                p.handle_weather_nulls(e.columns, self.raw.get(e.child), spec.pk, e.child_fk, e.cancelled_col,
                                       group_col=e.group_col, date_col=e.date_col, hour_col=e.hour_col)
            if spec.unique:
                p.df = materialize(p.df, f"cleaning-{name.lower()}")  # read for the rows kept and the rows dropped
                p.deduplicate(spec.unique)
                p.reset_serial_id(spec.pk)
            for c, low, high in spec.ranges:
                if c in p.df.columns:
                    p.fix_validity_range(c, low, high)
            if spec.repairs:
                spec.repairs(p)
            for c, parent, key in spec.fks:
                if parent in self.specs:
                    p.fix_fk_to_null(c, self.keys("after", parent, key), key, f"no such {key} in {parent}, emptied")
            if spec.weather_link in self.specs:
                p.fix_weather_observation_fk(self.clean(spec.weather_link))
            if spec.winsorize:
                p.winsorize_numeric(spec.winsorize, *spec.bounds)
            p.df = materialize(p.df, f"cleaning-{name.lower()}")
            self._plans[name] = p
        return self._plans[name]

    def clean(self, name: str) -> DataFrame:
        return self.plan(name).clean_df

    def clean_tables(self) -> dict[str, DataFrame]:
        return {name: self.clean(name) for name in self.order()}

    # -------------------------------------------------------------- reports
    def _each(self, report: Callable[[str], DataFrame]) -> DataFrame:
        out = None
        for name in self.order():
            part = report(name)
            out = part if out is None else out.unionByName(part)
        return out

    def audit_log(self, logged_at: str | None = None) -> DataFrame:
        """D26 of all tables; with the run's time as ``timestamp`` if it is given."""
        return self._each(lambda name: self.plan(name).audit_log(logged_at).withColumn("table_name", F.lit(name)))

    def dropped_rows(self) -> DataFrame:
        """(table_name, step, row_id) of every dropped row of every table."""
        def of(name):
            out = self.plan(name).dropped_rows().withColumn("table_name", F.lit(name))
            for owner, s in self.specs.items():
                if s.empty_rows and s.empty_rows.child == name and self.plan(owner).dropped_children is not None:
                    gone = self.plan(owner).dropped_children
                    out = out.unionByName(gone.select(F.lit("handle_weather_nulls_drop").alias("step"), F.col(self.specs[name].pk).cast("string").alias("row_id"),
                                                      F.lit(name).alias("table_name")))
            return out
        return self._each(of)

    def audit_summary(self) -> DataFrame:
        """D27 of all tables."""
        return self._each(lambda name: self.plan(name).audit_summary().withColumn("table_name", F.lit(name)))

    def counts(self) -> DataFrame:
        """Rows, columns and null cells of every raw and clean table."""
        return self._each(lambda name: table_counts(self.raw[name], self.clean(name), name).withColumn(
            "n_columns", F.lit(len(self.clean(name).columns)).cast("long")))

    def _score(self, phase: str, name: str) -> DataFrame:
        table = self.source(name) if phase == "before" else self.clean(name)
        parents = {r.fk[1]: r.fk[2] for r in self.rules[name].consistency if r.fk and r.fk[1] in self.specs}
        refs = {p: self.keys(phase, p, key) for p, key in parents.items()}
        return dqa.run_dqa(table, name, self.rules[name], refs, as_of=self.as_of)

    def scorecards(self, phase: str) -> DataFrame:
        """D9 of all tables, "before" or "after"."""
        return self._each(lambda name: self._score(phase, name))

    def comparison(self) -> DataFrame:
        """C8 of all tables."""
        return self._each(lambda name: dqa.compare_scorecards(self._score("before", name), self._score("after", name)).withColumn(
            "table_name", F.lit(name)))

    def validation(self) -> DataFrame:
        """H3: every clean table against the layout of its raw table; further columns are allowed."""
        contract, spark = SchemaContract(), next(iter(self.raw.values())).sparkSession
        for name in self.order():
            contract.register(name, self.raw[name], pk=self.specs[name].pk, count_rows=False)
        return contract.validate_all(spark, self.clean_tables(), strict=False)[0]
