"""Reports: digest blocks and dossiers as ordered lines, and their Markdown. A report is a top-k, so its lines are few; everything before is distributed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from evidentia.functions import text as tx


def digest(findings: DataFrame, target: str, company: str, date: str, filers: str, *, novel: Column, trap: Column, pinned: DataFrame | None = None, link: Column | None = None, limit: int = 10, softened: list[str] = ()) -> DataFrame:
    """(block, rank, line, overflow) in order: moves on pinned targets (four each), then of the first ``limit`` findings the novel, the others and the traps, latest first.
    ``filers`` is an array of names; softened targets are not called novel and get "+ others"."""
    soft = F.coalesce(F.col(target).isin(list(softened)), F.lit(False)) if softened else F.lit(False)
    block = F.when(F.coalesce(trap, F.lit(False)), 3).when(F.coalesce(novel, F.lit(False)) & ~soft, 1).otherwise(2)
    n = findings.count()
    order = [F.col("block"), F.col(date).desc_nulls_last(), F.col(target), F.col(company)]
    top = findings.withColumn("block", block).orderBy(*order).limit(limit)
    many = F.array_join(F.transform(F.slice(filers, 1, 3), lambda x: tx.title_case(x)), ", ")
    who = F.when(soft, F.concat(tx.title_case(F.col(company)), F.lit(" + others"))).when(F.size(filers) > 1, many).otherwise(tx.title_case(F.col(company)))
    when = F.when(F.col(date).isNotNull(), F.concat(F.lit(" ("), F.col(date).cast("string"), F.lit(")"))).otherwise(F.lit(""))
    see = F.when(link != "", F.concat(F.lit(" <"), link, F.lit("|see>"))).otherwise(F.lit("")) if link is not None else F.lit("")
    plain = F.concat(F.lit("- *"), F.col(target), F.lit("* - "), who, when, F.lit("."), see)
    warned = F.concat(F.lit("- *"), F.col(target), F.lit("*"), when, F.lit(" - "), tx.title_case(F.col(company)), F.lit(" has a new move, but skip it: the angle is taken."), see)
    rank = F.row_number().over(W.orderBy(*order))  # of at most ``limit`` rows
    lines = top.select("block", rank.alias("rank"), F.when(F.col("block") == 3, warned).otherwise(plain).alias("line"))
    if pinned is not None:
        own = W.partitionBy(target).orderBy(F.col(date).desc_nulls_last(), F.col(company))
        moves = pinned.withColumn("_n", F.row_number().over(own)).filter((F.col("_n") <= 4) | F.col(date).isNull())
        what = F.when(F.col(date).isNull(), F.lit("nothing new since the last check")).otherwise(F.concat(F.lit("new move from "), tx.title_case(F.substring(F.col(company), 1, 26)), F.lit(" ("), F.col(date).cast("string"), F.lit(")")))
        watch = moves.select(F.lit(0).alias("block"), F.row_number().over(W.orderBy(target, "_n")).alias("rank"), F.concat(F.lit("- *"), F.col(target), F.lit("* - "), what, F.lit(".")).alias("line"))
        lines = watch.unionByName(lines)
    return lines.withColumn("overflow", F.lit(max(0, n - limit)).cast("long")).orderBy("block", "rank")


def dossier(moves: DataFrame, target: str, company: str, date: str, lane: str, filers: str, *, names: Column, verdict: Column, verdicts: dict[str, int], limit: int = 12, lanes: tuple[str, ...] = ("OPEN", "EMERGING"), **facts: Column) -> DataFrame:
    """(rank, target, section): the latest moves in open lanes, the first ``limit`` of them, then sorted anew: confirmed by the title first, then by verdict, then latest."""
    order = F.lit(1)
    for name, r in verdicts.items():
        order = F.when(verdict == name, F.lit(r)).otherwise(order)
    first = moves.filter(F.col(lane).isin(*lanes)).withColumns({"_names": F.coalesce(names, F.lit(False)), "_v": verdict, "_o": F.coalesce(order, F.lit(1))})
    first = first.orderBy(F.col(date).desc_nulls_last(), F.col(target), F.col(company)).limit(limit)
    rank = F.row_number().over(W.orderBy(F.col("_names").desc(), F.when(F.col("_names"), F.col("_o")).otherwise(1), F.col(date).desc_nulls_last(), F.col(target), F.col(company)))
    flag = F.when(~F.col("_names"), F.lit("mis-attributed")).otherwise(F.coalesce(F.col("_v"), F.lit("?")))
    head = F.concat(F.lit("## "), F.col(target).cast("string"), F.lit(" - "), F.col(lane), F.lit(", "), F.col(filers).cast("string"), F.lit(" filer(s), "), flag)
    lines = [F.concat(F.lit("- **Who is moving:** "), F.col(company).cast("string"), F.lit(" ("), F.coalesce(F.col(date).cast("string"), F.lit("no date")), F.lit(")")), F.concat(F.lit("- **Title confirms target:** "), F.when(F.col("_names"), F.lit("yes")).otherwise(F.lit("no, verify")))]
    lines += [F.concat(F.lit(f"- **{k.replace('_', ' ')}:** "), F.coalesce(v.cast("string"), F.lit("none on record"))) for k, v in facts.items()]
    return first.select(rank.alias("rank"), F.col(target).alias("target"), F.concat_ws("\n", head, *lines).alias("section")).orderBy("rank")


def markdown(lines: DataFrame, text: str, *order: str, title: str = "") -> str:
    """One document of a report's lines, in order."""
    body = "\n\n".join(r[0] for r in lines.orderBy(*order).select(text).collect())
    return f"# {title}\n\n{body}\n" if title else body + "\n"


def softened_if_failed(findings: list[dict], check) -> list[str]:
    """Targets to soften after an outside check of each; if the check itself fails, all of them: nothing is called novel unchecked."""
    try:
        return [f["target"] for f in findings if check(f)]
    except Exception:  # any failure of a foreign service
        return [f["target"] for f in findings]
