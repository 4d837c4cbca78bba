"""Texts from game tables, and checks of texts against them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.functions import scalars
from logweave.operators import quality, textops

#: One registry of section titles for renderers, checks and splitters alike.
SECTIONS = {"turn": "TURN", "state": "GAME STATE", "history": "TURN HISTORY", "spreads": "SPREADS", "usage": "USAGE", "matrix": "THREAT MATRIX"}
#: Phrases that give away a label, case-insensitive.
LEAKS = (
    r"oracle",
    r"expert['’]?s?\s+(?:decision|answer|target|truth)",
    r"ground[- ]truth",
    r"correct\s+(?:answer|decision|play|action)",
    r"the\s+answer\s+(?:is|was)",
    r"the\s+target\s+(?:is|says|action|field|move|choice)",
    r"training[- ](?:mode|section|target|example)",
    r"i\s+know\s+the\s+(?:answer|correct)",
    r"given\s+the\s+answer",
)
LEAK = r"(?i)\b(?:" + "|".join(LEAKS) + r")\b"


def header(key: str) -> str:
    return f"=== {SECTIONS[key]} ==="


def event_line() -> Column:
    """One line for a turn event of the protocol tables."""
    hit = lambda h: F.concat(h["defender_slot"], F.when(h["outcome"] == "hit", F.concat(F.lit(" "), F.format_string("%.1f", h["hp_before_pct"]), F.lit("→"), F.format_string("%.1f", h["hp_after_pct"]), F.when(h["is_crit"], " crit").otherwise(""), F.when(h["is_ko"], " KO").otherwise(""))).otherwise(F.concat(F.lit(" "), h["outcome"])))
    hits = F.array_join(F.transform(F.coalesce("hits", F.array()), hit), ", ")
    return (
        F.when(F.col("type") == "move", F.concat(F.col("attacker_slot"), F.lit(": "), F.col("move_name"), F.when(hits != "", F.concat(F.lit(" → "), hits)).otherwise("")))
        .when(F.col("type") == "switch", F.concat(F.col("slot"), F.lit(": "), F.coalesce("from_species", F.lit("–")), F.lit(" ⇒ "), F.col("to_species")))
        .when(F.col("type") == "cant_move", F.concat(F.col("slot"), F.lit(": can't move ("), F.col("reason"), F.lit(")")))
        .when(F.col("type") == "faint", F.concat(F.col("slot"), F.lit(": "), F.coalesce("species", F.lit("?")), F.lit(" fainted")))
        .when(F.col("type") == "tera", F.concat(F.col("slot"), F.lit(": terastallized into "), F.col("to_type")))
        .when(F.col("type") == "item_event", F.concat(F.col("slot"), F.lit(": "), F.col("item"), F.lit(" "), F.col("kind")))
    )


def history(events: DataFrame) -> DataFrame:
    """game_id, turn, text: one block per turn; a faint that the turn's KO already tells is left out."""
    kos = F.flatten(F.collect_list(F.transform(F.filter(F.coalesce("hits", F.array()), lambda h: h["is_ko"]), lambda h: h["defender_slot"])).over(Window.partitionBy("game_id", "turn")))
    told = (F.col("type") == "faint") & F.array_contains(kos, F.col("slot"))
    e = events.withColumn("line", event_line()).withColumn("__told", told).where("NOT __told")
    lines = F.transform(F.array_sort(F.collect_list(F.struct("event_pos", "line"))), lambda x: x["line"])
    return e.groupBy("game_id", "turn").agg(F.concat(F.lit("Turn "), F.first("turn").cast("string"), F.lit("\n  "), F.array_join(lines, "\n  ")).alias("text"))


def state_lines(snapshots: DataFrame) -> DataFrame:
    """game_id, turn, text: the state section."""
    line = F.concat(F.lit("["), F.col("slot"), F.lit("] "), F.coalesce("species", F.lit("?")), F.lit(" | HP "), F.when(F.col("fainted"), "0%").otherwise(scalars.percent_text(F.col("hp_percent"))), F.when(F.size("revealed_moves") > 0, F.concat(F.lit(" | moves: "), F.array_join("revealed_moves", ", "))).otherwise(""), F.when(F.col("terastallized"), " | Tera").otherwise(""))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("slot", line.alias("line")))), lambda x: x["line"])
    return snapshots.groupBy("game_id", "turn").agg(F.concat(F.lit(header("state") + "\n"), F.array_join(lines, "\n")).alias("text"))


def matrix_line() -> Column:
    return F.concat(F.lit("  "), F.col("move"), F.lit(" → "), F.rpad("defender", 14, " "), F.lit(" "), scalars.range_text(F.col("lo"), F.col("hi")))


_ENTRY = r"(?m)^  (\S.*?) → (\S.*?) +(-?[0-9.]+)–(-?[0-9.]+)%(?: (\S+))?$"


def matrix_entries(text: Column) -> Column:
    """move, target, lo, hi, label (empty without one) of every matrix line of a text, in order: what ``matrix_line`` renders, read back."""
    part = lambda k: F.regexp_extract_all(text, F.lit(_ENTRY), F.lit(k))
    zipped = F.arrays_zip(*[part(k).alias(n) for k, n in enumerate(("move", "target", "lo", "hi", "label"), 1)])
    return F.transform(zipped, lambda e: e.withField("lo", e["lo"].cast("double")).withField("hi", e["hi"].cast("double")))


def usage_block(top: DataFrame) -> DataFrame:
    """species_key, text: a line of shares for each field of ``usage.top_shares``."""
    lists = top.groupBy("species_key", "field").agg(F.array_sort(F.collect_list(F.struct("rank", "value", "usage_pct"))).alias("x"))  # a few ranks
    line = F.concat(F.lit("  "), F.col("field"), F.lit(": "), scalars.share_text(F.transform("x", lambda e: e["value"]), F.transform("x", lambda e: e["usage_pct"])))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("field", line.alias("line")))), lambda e: e["line"])
    return lists.groupBy("species_key").agg(F.concat_ws("\n", F.first("species_key"), lines).alias("text"))


def prompt(parts: list[Column]) -> Column:
    """Sections joined, empty ones skipped."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != "")), "\n\n")


@F.udtf(returnType="species string, start int")
class Mentions:
    """All places at which names occur in a text, whole words, any case."""

    names: list | None = None
    patterns: tuple | list = ()

    def eval(self, text: str, names: list) -> Iterator[tuple[str, int]]:
        import re

        if names != self.names:  # compiled once for rows that share their names
            self.names, self.patterns = names, [(n, re.compile(rf"(?<!\w){re.escape(n)}(?!\w)", re.IGNORECASE)) for n in names or []]
        for name, pattern in self.patterns:
            for m in pattern.finditer(text or ""):
                yield name, m.start()


def on_field_hp(text: Column) -> Column:
    """Map from name key to health percent of the active lines; the last of equal names wins."""
    raw = textops.key_values(text, r"\[(?:p[12])?[abc]\]\s+([A-Za-z0-9'.\- ]+?)\s+\|\s+HP\s+(\d+(?:\.\d+)?)\s*%")
    keyed = F.transform(F.map_entries(raw), lambda e: F.struct(scalars.name_key(e["key"]), e["value"].cast("double")))
    return F.map_from_entries(keyed)


def grounded_claims(claims: DataFrame, most: int = 70) -> DataFrame:
    """``claims`` (row_id, target_pos, target, lo, hi, ko_pos, hp) with violation: only claims whose KO word is near, once for each (row, target, lo, hi)."""
    near = claims.where((F.col("ko_pos") >= F.col("target_pos")) & (F.col("ko_pos") - F.col("target_pos") <= most))
    v = near.withColumn("violation", textops.claim_violation(F.col("lo"), F.col("hi"), F.col("hp"))).where("violation IS NOT NULL")
    return v.dropDuplicates(["row_id", "violation", "target", "lo", "hi"])


def row_checks() -> dict[str, quality.Check]:
    """Checks of training rows (user STRING, messages): sections, leftovers, one final call, calls answered, leaks; the last not on dry runs."""
    calls = F.flatten(F.transform(F.filter("messages", lambda m: m["tool_calls"].isNotNull()), lambda m: m["tool_calls"]))
    ids = F.transform(calls, lambda t: t["id"])
    answers = F.transform(F.filter("messages", lambda m: m["tool_call_id"].isNotNull()), lambda m: m["tool_call_id"])
    final = F.filter(calls, lambda t: t["function"]["name"] == "submit_decision")
    thought = F.get_json_object(F.try_element_at(final, F.lit(1))["function"]["arguments"], "$.pre_tool_thought")
    real = ~F.coalesce(F.contains(thought, F.lit("[DRY RUN")), F.lit(False))
    missing = F.lit(False)
    for key in ("state", "matrix"):
        missing = missing | ~F.contains("user", F.lit(header(key)))
    return {
        "prompt_sections": quality.Check(missing),
        "template_leftovers": quality.Check(F.rlike("user", F.lit(r"\{[a-z_]+\}"))),
        "one_submit": quality.Check(F.size(final) != 1),
        "calls_answered": quality.Check(F.size(F.array_except(F.filter(ids, lambda i: ~F.array_contains(F.transform(final, lambda t: t["id"]), i)), answers)) > 0),
        "leak": quality.Check(F.rlike(F.coalesce(thought, F.lit("")), F.lit(LEAK)), real),
    }


def text_checks() -> dict[str, quality.Check]:
    """Checks of rows with user (text) and action (JSON): matrix ranges, knock-out labels against the health shown, and the structure of both slots' actions."""
    entries, health = matrix_entries(F.col("user")), on_field_hp(F.col("user"))
    shown = lambda e: F.try_element_at(health, scalars.name_key(e["target"]))
    at = lambda slot, name: F.get_json_object("action", f"$.{slot}.{name}")
    broken = F.lit(False)
    for slot in ("slot_1", "slot_2"):
        kind, given = at(slot, "action_type"), lambda n, slot=slot: F.coalesce(at(slot, n), F.lit("")) != ""
        sound = F.when(kind == "move", given("move")).when(kind == "switch", given("switch_to")).otherwise(kind == "pass")
        broken = broken | ~F.coalesce(sound, F.lit(False))
    return {
        "matrix_ranges": quality.Check(F.exists(entries, lambda e: (e["lo"] > e["hi"] + 1e-6) | (e["lo"] < 0) | (e["hi"] > 10_000))),
        "ko_labels": quality.Check(F.exists(entries, lambda e: (e["label"] == "OHKO") & (e["lo"] < shown(e) - 5))),
        "action_structure": quality.Check(broken),
    }
