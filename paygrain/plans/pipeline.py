"""The pipeline as a fold over named steps; each takes and returns tables, results of the costly ones are written.

    Pipeline(spark, "file:///shared/run").run({"declarations": df, "secteurs": ref})
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, clean, intervals, models, panel, refjoin, stats
from ..session import materialise
from .catalog import DIMENSIONS, MERGES, MODELS, RULES, Dimension, MergeSpec, ModelSpec, Rule, dimensions
from .sessions import Sessions


@dataclass(frozen=True)
class Settings:
    """filters: apply the cleaning filters, off by default. imputations: copies of the wage imputation, 0 for none.
    pseudo_rows: imputed employer-months without individuals take part in the estimates. checks: run the audits."""

    filters: bool = False
    imputations: int = 5
    pseudo_rows: bool = True
    checks: bool = True
    seed: int = 1
    rules: clean.CleanRules = clean.CleanRules()
    dimensions: tuple[Dimension, ...] = tuple(DIMENSIONS)
    merges: tuple[MergeSpec, ...] = tuple(MERGES)
    models: tuple[ModelSpec, ...] = tuple(MODELS)
    checks_rules: tuple[Rule, ...] = tuple(RULES)


@dataclass
class Run:
    """Tables and figures by name, and a line per step."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    figures: dict[str, Any] = field(default_factory=dict)
    log: list[str] = field(default_factory=list)


CARRIED = ("secteur_activite_cod", "classe_effectif_reduite", "age_entreprise_immat", "commune")


class Pipeline:
    STEPS = ("check", "prepare", "merge", "structure", "weight", "impute", "estimate", "validate")

    def __init__(self, spark: SparkSession, sessions: str | None = None, settings: Settings = Settings()):
        self.spark, self.settings = spark, settings
        self.sessions = Sessions(sessions) if sessions else None

    def run(self, tables: dict[str, DataFrame], steps: str | Sequence[str] = "all") -> Run:
        """Run steps in their order on tables['declarations'] and lookups named in the merge specs. A failed step closes
        the session as failed and raises."""
        want = self.STEPS if steps == "all" else ([steps] if isinstance(steps, str) else list(steps))
        if unknown := set(want) - set(self.STEPS):
            raise ValueError(f"unknown steps: {sorted(unknown)}")
        r = Run({k: v for k, v in tables.items()})
        ident = self.sessions.create({"steps": list(want), **{k: getattr(self.settings, k) for k in ("filters", "imputations", "pseudo_rows", "seed")}}) if self.sessions else None
        try:
            for s in self.STEPS:
                if s in want:
                    getattr(self, f"_{s}")(r)
                    r.log.append(s)
        except Exception as e:
            if self.sessions:
                self.sessions.close(ident, "failed", r.figures, str(e))
            raise
        if self.sessions:
            self.sessions.close(ident, "completed", r.figures | {"tables": sorted(r.tables)})
        return r

    def _check(self, r: Run) -> None:
        if self.settings.checks:
            d = r.tables["declarations"]
            r.tables["rules"] = audit.check_rules(d, self.settings.checks_rules)
            r.tables["fill"] = audit.fill_profile(d)

    def _prepare(self, r: Run) -> None:
        d = clean.harmonise(r.tables["declarations"])
        d = clean.derive(d.withColumn("annee", F.col("annee").cast("int")).withColumn("mois", F.col("mois").cast("int")))
        r.tables["declarations"] = clean.apply_filters(d, self.settings.rules) if self.settings.filters else d

    def _merge(self, r: Run) -> None:
        specs = [replace(m, key=m.key.lower(), ref_key=m.ref_key.lower(), keep=tuple(c.lower() for c in m.keep), drop=tuple(c.lower() for c in m.drop)) for m in self.settings.merges]
        r.tables["declarations"], r.figures["merges"] = refjoin.merge_all(r.tables["declarations"], specs, lambda n: r.tables[n])

    def _structure(self, r: Run) -> None:
        d = r.tables["declarations"]
        r.tables["individual"] = materialise(panel.individual_base(d), "individual")
        carried = [c for c in CARRIED if c in d.columns]
        r.tables["firm_time"] = materialise(panel.panel(r.tables["individual"].where("numero_employeur IS NOT NULL"), carried=carried), "firm-time")

    def _weight(self, r: Run) -> None:
        spec = self.settings.models[0]
        p = r.tables["firm_time"]
        m = models.fit_logit(p, replace(spec, outcome="d_jt"))
        r.figures["declaration"] = m.figures | {"dropped": m.dropped}
        scored = materialise(models.predict(p, m, "pi_jt"), "probabilities")
        weighted = models.inverse_weights(scored, "pi_jt", "w_jt", spec.floor, spec.stabilise, spec.trim)
        r.tables["firm_time"] = materialise(weighted, "firm-time-weighted")
        i = panel.attach_weights(r.tables["individual"], r.tables["firm_time"].select("numero_employeur", "annee", "mois", "w_jt"), ["numero_employeur", "annee", "mois"], "w_jt")
        i = i.withColumn("w_final", panel.weight_product(F.col("w_jt"), F.col("w_ijt")))
        r.tables["analytical"] = materialise(i, "analytical")

    def _impute(self, r: Run) -> None:
        if not self.settings.imputations:
            return
        p = r.tables["firm_time"]
        m = models.fit_linear(p.where("d_jt = 1"), replace(self.settings.models[1], outcome="log_y_bar_jt"))
        r.figures["imputation"] = m.figures | {"dropped": m.dropped}
        missing = models.impute(p.where("d_jt = 0"), m, ["numero_employeur", "annee", "mois"], self.settings.imputations, self.settings.seed)
        keys = ["numero_employeur", "annee", "mois"]
        gaps = materialise(missing.select(*keys, "imputation_id", "imputed", *[c for c in CARRIED if c in missing.columns], "w_jt"), "imputed")
        r.tables["imputed"] = gaps
        full = models.stack_imputations(r.tables["analytical"], gaps, keys, "salaire_brut_mens", pseudo_rows=False)
        if self.settings.pseudo_rows:
            extra = gaps.join(r.tables["analytical"].select(*keys).distinct(), keys, "left_anti").withColumnRenamed("imputed", "salaire_brut_mens")
            full = full.unionByName(extra.withColumn("w_final", F.col("w_jt")), allowMissingColumns=True)
        r.tables["completed"] = full

    def _estimate(self, r: Run) -> None:
        a = r.tables["analytical"]
        dims = dimensions(a.columns, self.settings.dimensions)
        one = stats.all_dimensions(a, dims, "salaire_brut_mens", "w_final")
        r.tables["estimates"] = materialise(stats.publishable(one, dims), "estimates")
        if "completed" in r.tables:
            many = stats.all_dimensions(r.tables["completed"], dims, "salaire_brut_mens", "w_final", extra=["imputation_id"])
            names = ["mean", "variance", "min", "max", "q1", "median", "q3", "p10", "p90"]
            r.tables["combined"] = intervals.combine_dimensions(many, names, [*stats.KEYS, "annee", "mois"])

    def _validate(self, r: Run) -> None:
        v = audit.validate_estimates(r.tables["estimates"]).first()
        r.figures["validation"] = v.asDict()
        if v["small_cells"]:
            r.tables["estimates"] = stats.suppress(r.tables["estimates"])
