"""Whole questions about a log, put together from the operators."""

from collections.abc import Iterable
from copy import copy

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.expressions import guard_message, show_all_columns
from wardline.operators.classify import classify_operation
from wardline.operators.decide import audit_rows, decide, statement_verdict
from wardline.operators.delta import touched_statements
from wardline.operators.guards import excluded, excluded_keys, visible_tables
from wardline.operators.history import as_of
from wardline.operators.objects import build_objects
from wardline.operators.requests import build_requests
from wardline.operators.sizing import fits
from wardline.session import written


class Governance:
    """A log, its catalog and the grants; every property of it is a lazy DataFrame.

    With `versions`, `grants` is a history (`since`, `until`), and each statement is judged by what held
    at its time. Listings show what holds now.
    """

    def __init__(
        self,
        stmts: DataFrame,
        rels: DataFrame,
        inv: DataFrame,
        grants: DataFrame,
        excluded_settings: Iterable[str] = (),
        show_columns_option: str = "NONE",
        cluster: str = "",
        unresolved_with_db: bool = False,
        bucketed: bool = False,
        null_allows: bool = True,
        versions: DataFrame | None = None,
        **sizes,
    ):
        self.inv, self.grants, self.null_allows, self.sizes = inv, grants, null_allows, sizes
        self.patterns = excluded_keys(excluded_settings)
        self.classified = classify_operation(stmts)
        self.objects = build_objects(self.classified, rels, inv, unresolved_with_db, bucketed)
        self.requests = build_requests(self.objects, show_all_columns(show_columns_option), cluster)
        if versions is not None:
            self.requests = as_of(self.requests, versions)
        self._decisions, self._stored = None, False

    def stored(self) -> "Governance":
        """This, with the requests written once for all that is asked of them from now on."""
        if not self._stored:
            self.requests, self._decisions, self._stored = written(self.requests, "requests"), None, True
        return self

    def under(self, grants: DataFrame) -> "Governance":
        """The same log under other grants: its requests are those of this one."""
        other = copy(self)
        other.grants, other._decisions = grants, None
        return other

    @property
    def decisions(self) -> DataFrame:
        if self._decisions is None:
            self._decisions = decide(self.requests, self.grants, self.null_allows, **self.sizes)
        return self._decisions

    @property
    def audit(self) -> DataFrame:
        return audit_rows(self.decisions)

    @property
    def verdicts(self) -> DataFrame:
        """`stmt_id, user_name, op, allowed, message`; SET statements are judged by the settings guard."""
        return self._judged(self.classified, self.decisions)

    def verdicts_after(self, verdicts: DataFrame, before: DataFrame) -> DataFrame:
        """The verdicts under these grants, from those under the grants `before`.

        Only statements that a changed grant speaks of are judged again; what was said of all others is
        carried over. `verdicts` must be of this log. The requests are stored, as they are asked twice.
        """
        self.stored()
        touched = written(touched_statements(self.requests, before, self.grants, **self.sizes), "touched")
        few = F.broadcast(touched) if fits(touched) else touched
        again = decide(self.requests.join(few, "stmt_id", "left_semi"), self.grants, self.null_allows, **self.sizes)
        judged = self._judged(self.classified.join(few, "stmt_id", "left_semi"), again)
        return verdicts.join(few, "stmt_id", "left_anti").unionByName(judged)

    def _judged(self, classified: DataFrame, decisions: DataFrame) -> DataFrame:
        guarded = (F.col("command") == "SetCommand") & excluded(F.col("conf_key"), self.patterns)
        noted = classified.withColumn("guard_message", F.when(F.coalesce(guarded, F.lit(False)), guard_message()))
        judged = statement_verdict(noted, decisions, keep=["guard_message"])
        return judged.select(
            "stmt_id",
            "user_name",
            "op",
            (F.col("allowed") & F.col("guard_message").isNull()).alias("allowed"),
            F.coalesce("guard_message", "message").alias("message"),
        )

    @property
    def listings(self) -> DataFrame:
        """What SHOW TABLES shows to each user of the database asked about."""
        asking = self.classified.where(F.col("command") == "ShowTablesCommand")
        held = self.grants.where("until IS NULL") if "until" in self.grants.columns else self.grants
        return visible_tables(self.inv, held, asking.select("user_name", "db"))
