"""Evaluation reports as ordered text blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.functions.text import normalize_space
from loamwork.functions.values import status_icon, verdict_bucket
from loamwork.operators.aggregates import weighted_score


def report_blocks(evals: DataFrame, candidate: str, order: str, title: str = "Evaluation report", evidences: int | None = None, characters: int | None = None) -> DataFrame:
    """(candidate, section, place, text): Markdown blocks of an evaluation report.

    Section 0 is the header with the weighted score, 1 the table (a line per requirement), 2 the
    notes with all evidences, or the first ``evidences`` of up to ``characters`` each. Sorted by section and place the
    blocks are the report; no candidate's rows are gathered in one task.

    evals(candidate, order, job_title, requirement_id, requirement, status, score, weight,
    priority, explanation, risk_note, evidence_used)
    """
    c, lit = F.col, F.lit
    scores = weighted_score(evals, candidate, "weight", "score")
    titles = evals.groupBy(candidate).agg(F.min_by("job_title", order).alias("job_title"))
    # fixed values: wording of the report
    head = F.concat(
        lit(f"# {title}\n\n**Pozicia:** "), c("job_title"), lit("\n**Celkove skore:** "), F.format_string("%.2f", c("weighted_score")),
        lit(" / 100\n**Odporucanie:** "), verdict_bucket(c("weighted_score")),
        lit("\n\n> Vystup je odporucanie pre cloveka, nie automaticke rozhodnutie o kandidatovi.\n\n## Vyhodnotenie poziadaviek\n\n"
            "| Stav | Poziadavka | Skore | Priorita | Vysvetlenie |\n|---|---|---:|---|---|"),
    )
    header = scores.join(titles, candidate).select(candidate, lit(0).alias("section"), lit(0).cast("bigint").alias("place"), head.alias("text"))
    icon = status_icon(c("status"))
    row = F.concat(
        lit("| "), icon, lit(" "), c("status"), lit(" | "), F.replace(c("requirement"), lit("|"), lit("/")), lit(" | "), F.format_string("%.0f", c("score")),
        lit(" | "), c("priority"), lit(" / w="), c("weight").cast("string"), lit(" | "), F.replace(c("explanation"), lit("|"), lit("/")), lit(" |"),
    )
    used = F.coalesce("evidence_used", F.array().cast("array<string>"))
    shown = lambda e: normalize_space(e) if characters is None else F.left(normalize_space(e), lit(characters))
    cited = F.transform(used if evidences is None else F.slice(used, 1, evidences), lambda e: F.concat(lit("- "), shown(e)))
    note = F.concat(
        lit("### "), icon, lit(" "), c("requirement_id"), lit(": "), c("requirement"),
        F.when(F.coalesce("risk_note", lit("")) != "", F.concat(lit("\n**Riziko/neistota:** "), c("risk_note"))).otherwise(""),
        F.when(F.size(cited) > 0, F.concat(lit("\n**Pouzite odkazy:**\n"), F.array_join(cited, "\n"))).otherwise(""),
    )
    both = F.array(F.struct(lit(1).alias("section"), row.alias("text")), F.struct(lit(2).alias("section"), note.alias("text")))
    body = evals.select(candidate, c(order).cast("bigint").alias("place"), F.explode(both).alias("b")).select(candidate, "b.section", "place", "b.text")
    return header.unionByName(body)
