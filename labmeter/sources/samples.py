"""Usage tables derived from the sample parquet tables (events, customer, orders, ...).

One lab per user, one usage event per sample event, one employee per customer,
one extra reservation per order. Everything stays lazy and runs over whole tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmeter.functions.clock import whole_second
from labmeter.functions.names import CREATED_FORMAT
from labmeter.sources.conform import conform_names

NOW = "2024-01-31 00:00:00"

OPERATION_OF_TYPE = {
    "click": "login", "view": "logout", "signup": "Powered-On",
    "purchase": "Suspended", "error": "Deleted",
}
OP_OF_TYPE = {"signup": 0, "purchase": 1, "error": 2}

# Columns in use; a given schema spares the job that would read it from a file footer.
COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
}


class SampleTables:
    """The usage tables of one sample folder; each is built once, when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._dir = spark, sf_dir

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.schema(COLUMNS[name]).parquet(f"{self._dir}/{name}.parquet")

    @cached_property
    def _events(self) -> DataFrame:
        return self._read("events")

    @cached_property
    def labs(self) -> DataFrame:
        """user_id, vm_name, lab, email, rdp, start_ts, end_ts."""
        firsts = self._events.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
        named = firsts.select("user_id", whole_second(F.col("first_ts")).alias("start_ts")).selectExpr(
            "user_id", "start_ts", "concat('Lab ', user_id % 5) AS lab",
            "concat('user', user_id % 30) AS owner",
            "if(user_id % 2 = 0, '-Persistent-(', '-(') AS mark",
            f"concat(date_format(start_ts, '{CREATED_FORMAT}'), ':000001') AS created",
        )
        return named.selectExpr(
            "user_id", "concat(lab, mark, owner, ')-', created) AS vm_name", "lab",
            "concat(owner, '@example.com') AS email",
            "concat('10.240.', user_id % 7, '.', user_id) AS rdp",
            "start_ts", "start_ts + make_dt_interval(int(user_id % 40 + 5)) AS end_ts",
        )

    @cached_property
    def reservations(self) -> DataFrame:
        return self.labs.drop("user_id")

    @cached_property
    def _lab_events(self) -> DataFrame:
        """event_id, event_type, vm_name, rdp, ts."""
        owners = self.labs.select("user_id", "vm_name", "rdp")
        events = self._events.select(
            "event_id", "user_id", "event_type", whole_second(F.col("ts")).alias("ts")
        )
        return events.join(owners, "user_id")

    def _of_types(self, *types: str) -> DataFrame:
        return self._lab_events.filter(F.col("event_type").isin(*types))

    @cached_property
    def logins(self) -> DataFrame:
        return self._of_types("click").select("vm_name", F.col("ts").alias("login_ts"))

    @cached_property
    def logouts(self) -> DataFrame:
        return self._of_types("view").select("vm_name", F.col("ts").alias("logout_ts"))

    @cached_property
    def power_log(self) -> DataFrame:
        cases = " ".join(f"WHEN '{kind}' THEN '{OPERATION_OF_TYPE[kind]}'" for kind in OP_OF_TYPE)
        return self._of_types(*OP_OF_TYPE).selectExpr(
            "vm_name", "ts AS log_ts", f"CASE event_type {cases} END AS operation"
        )

    @cached_property
    def power_ops(self) -> DataFrame:
        cases = " ".join(f"WHEN '{kind}' THEN {op}" for kind, op in OP_OF_TYPE.items())
        return self._of_types(*OP_OF_TYPE).selectExpr(
            "vm_name", "ts", f"CASE event_type {cases} END AS op"
        )

    @cached_property
    def employees(self) -> DataFrame:
        staff = self._read("customer").join(
            self._read("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return staff.selectExpr(
            "concat('user', c_custkey, '@example.com') AS email", "c_name AS full_name",
            "r_name AS region", "n_name AS location",
            "concat('Manager ', c_nationkey % 7) AS manager",
            "concat('Unit ', c_nationkey % 3) AS business_unit", "c_mktsegment AS department",
            "concat('Title ', c_custkey % 4) AS business_title",
            "CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS ase",
        )

    @cached_property
    def order_reservations(self) -> DataFrame:
        """A larger reservations table for summaries and pivots, without an RDP."""
        return self._read("orders").selectExpr(
            "concat('vm-', o_orderkey) AS vm_name",
            "concat('user', o_custkey, '@example.com') AS email", "o_orderpriority AS lab",
            "o_orderdate AS start_ts",
            "o_orderdate + make_dt_interval(int(o_orderkey % 30 + 1)) AS end_ts",
        )

    @cached_property
    def address_events(self) -> DataFrame:
        """Every logon and logoff as a collector sees it: text that holds the address."""
        return self._of_types("click", "view").selectExpr(
            "event_id", "ts", "if(event_type = 'click', 'in', 'out') AS action",
            "concat('Host Name : pc\\nIPv4 Address : ', rdp) AS config_text",
            "concat('eth0 u/u ', rdp, '/24 LAN') AS router_text",
        )


# Rules that the plain views never meet, the same for Spark and the SQL twins: what replaces a column of a view.
ODD_LABS = {
    "email": "CASE WHEN user_id % 11 = 3 THEN NULL ELSE email END",
    "rdp": "CASE WHEN user_id % 17 = 7 THEN NULL WHEN user_id % 19 = 1 THEN '10.240.1.1' ELSE rdp END",
    "end_ts": "CASE WHEN user_id % 13 = 5 THEN NULL ELSE end_ts END",
}
ODD_OPERATION = """CASE
    WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'Created' WHEN event_type = 'signup' AND event_id % 5 = 1 THEN 'powered-on'
    WHEN event_type = 'signup' THEN 'Powered-On' WHEN event_type = 'purchase' AND event_id % 7 = 0 THEN NULL
    WHEN event_type = 'purchase' AND event_id % 7 = 1 THEN 'Paused' WHEN event_type = 'purchase' THEN 'Suspended'
    WHEN event_id % 3 = 0 THEN 'DELETED' ELSE 'Deleted' END"""
ODD_RESERVATIONS = {
    "email": "CASE WHEN res_no % 23 = 0 THEN NULL ELSE email END",
    "lab": "CASE WHEN res_no % 2 = 0 THEN lower(lab) ELSE lab END",
}


class OddTables(SampleTables):
    """The same tables with missing mails, ends, addresses and operations, created and unknown operations, addresses
    that several reservations share, and names in any case, which are conformed as they are taken in."""

    @cached_property
    def labs(self) -> DataFrame:
        plain = SampleTables.labs.func(self)
        return plain.selectExpr(*[f"{ODD_LABS.get(c, c)} AS {c}" for c in plain.columns])

    @cached_property
    def _lab_events(self) -> DataFrame:
        spelled = "CASE event_id % 3 WHEN 0 THEN upper(vm_name) WHEN 1 THEN lower(vm_name) ELSE vm_name END"
        raw = SampleTables._lab_events.func(self).withColumn("vm_name", F.expr(spelled))
        return conform_names(raw, self.reservations)

    @cached_property
    def power_log(self) -> DataFrame:
        return self._of_types(*OP_OF_TYPE).selectExpr("vm_name", "ts AS log_ts", f"{ODD_OPERATION} AS operation")

    @cached_property
    def order_reservations(self) -> DataFrame:
        plain = SampleTables.order_reservations.func(self).withColumn("res_no", F.expr("int(substring(vm_name, 4))"))
        return plain.selectExpr(*[f"{ODD_RESERVATIONS.get(c, c)} AS {c}" for c in plain.columns if c != "res_no"])
