"""Tables as cells (ref, t, r, c, cell) and the joins that read values out of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserix.functions.text import extract, is_placeholder, norm, quoted

HEADER_LENGTH = 60


def cells_of(texts: DataFrame, table_separator: str = "\f") -> DataFrame:
    """Cells of tab-separated texts (ref, text): tables split at a form feed, rows at line feeds, cells at tabs, each normed."""
    tables = texts.select("ref", F.posexplode(F.split("text", table_separator)).alias("t", "__table"))
    rows = tables.select("ref", "t", F.posexplode(F.split("__table", "\n")).alias("r", "__row"))
    return rows.select("ref", "t", "r", F.posexplode(F.split("__row", "\t")).alias("c", "__cell")).select("ref", "t", "r", "c", norm(F.col("__cell")).alias("cell"))


def row_lines(cells: DataFrame) -> DataFrame:
    """(ref, t, r, line): the cells of each row joined by one space and normed."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("c", "cell"))), lambda x: x["cell"])
    return cells.groupBy("ref", "t", "r").agg(norm(F.array_join(ordered, " ")).alias("line"))


def grid_text(cells: DataFrame) -> DataFrame:
    """(ref, text): one line per row, tables in order; empty lines left out."""
    lines = row_lines(cells).where("line <> ''")
    return lines.groupBy("ref").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", "r", "line"))), lambda x: x["line"]), "\n").alias("text"))


def header_zone(cells: DataFrame, tokens: list[str]) -> DataFrame:
    """(ref, t, first, last): the first unbroken run of rows with a short cell that holds one of the tokens; tables without one are left out."""
    token = F.lit(False)
    for x in tokens:
        token = token | F.lower("cell").contains(x.lower())
    is_header = (F.length("cell") <= HEADER_LENGTH) & token
    rows = cells.groupBy("ref", "t", "r").agg(F.bool_or(is_header).alias("header"))
    order = Window.partitionBy("ref", "t").orderBy("r")
    # Islands: within a run of header rows, the row number less the place among header rows is constant.
    island = rows.where("header").withColumn("island", F.col("r") - F.row_number().over(order))
    runs = island.groupBy("ref", "t", "island").agg(F.min("r").alias("first"), F.max("r").alias("last"))
    return runs.groupBy("ref", "t").agg(F.min(F.struct("first", "last")).alias("z")).select("ref", "t", "z.first", "z.last")


def resolve_columns(cells: DataFrame, zone: DataFrame, match_header: str, value_headers: list[str]) -> DataFrame:
    """(ref, t, first, last, match_col, value_col).

    The match column is the first whose stacked header holds match_header; the
    value column holds all value headers, most of them as whole cells, leftmost
    on a tie.
    """
    stacked = cells.join(zone, ["ref", "t"]).where("r between first and last").groupBy("ref", "t", "first", "last", "c").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", F.lower("cell").alias("cell")))), lambda x: x["cell"]), " ").alias("head"), F.collect_set(F.lower("cell")).alias("whole"))
    wanted = [x.lower() for x in value_headers]
    holds = F.lit(True)
    exact = F.lit(0)
    for x in wanted:
        holds = holds & F.col("head").contains(x)
        exact = exact + F.array_contains("whole", x).cast("int")
    best = F.max(F.when(holds, F.struct(exact.alias("exact"), (-F.col("c")).alias("left"))))
    found = stacked.groupBy("ref", "t", "first", "last").agg(F.min(F.when(F.col("head").contains(match_header.lower()), F.col("c"))).alias("match_col"), best.alias("best"))
    return found.select("ref", "t", "first", "last", "match_col", (-F.col("best.left")).alias("value_col")).where("match_col is not null and value_col is not null")


def marked_tables(cells: DataFrame, marker: str) -> DataFrame:
    """(ref, t, marker_row) of tables where one whole cell equals the marker."""
    return cells.where(norm(F.col("cell")) == F.trim(F.lit(marker))).groupBy("ref", "t").agg(F.min("r").alias("marker_row"))


def fee_rows(cells: DataFrame, aliases: DataFrame, match_header: str, value_headers: list[str], value_pattern: str | None = None, marker: str | None = None) -> DataFrame:
    """(program_id, ref, t, r, value, segments): the value column's cell in the first row below the header whose match column holds the alias.

    aliases are (program_id, ref, alias).  Empty cells and placeholders give way
    to the next row or table.
    """
    own = cells
    if marker is not None:
        own = cells.join(marked_tables(cells, marker), ["ref", "t"])
    where = resolve_columns(own, header_zone(own, [match_header, *value_headers]), match_header, value_headers)
    body = own.join(where, ["ref", "t"]).where("r > last")
    keys = body.where("c = match_col").select("ref", "t", "r", F.col("cell").alias("key"))
    values = body.where("c = value_col").select("ref", "t", "r", norm(F.col("cell")).alias("raw"))
    rows = keys.join(values, ["ref", "t", "r"]).where((F.col("raw") != "") & ~is_placeholder(F.col("raw")))
    hits = rows.join(aliases, "ref").where(F.contains("key", "alias"))
    first = hits.groupBy("program_id", "ref").agg(F.min(F.struct("t", "r", "raw")).alias("h")).select("program_id", "ref", "h.t", "h.r", "h.raw")
    value = F.col("raw")
    if value_pattern is not None:
        part = F.regexp_extract("raw", f"^(?:{value_pattern})", 1)
        value = F.when(part != "", part).otherwise(F.col("raw"))
    lined = first.join(row_lines(own), ["ref", "t", "r"])
    segments = F.array("line")
    if marker is not None:
        at = marked_tables(cells, marker).join(row_lines(cells).withColumnsRenamed({"r": "marker_row", "line": "marker_line"}), ["ref", "t", "marker_row"]).select("ref", "t", "marker_line")
        lined, segments = lined.join(at, ["ref", "t"]), F.array("line", "marker_line")
    return lined.select("program_id", "ref", "t", "r", norm(value).alias("value"), segments.alias("segments"))


def in_sections(lines: DataFrame, sections: list[tuple[str, str, bool]]) -> DataFrame:
    """Lines (ref, t, r, line) with the section (track, foreign, its line) in force, carried forward over rows and tables.

    sections are (track, text, foreign) in order; the first whose text a line holds is its section.
    """
    own = F.lit(None).cast("struct<track:string,foreign:boolean>")
    for track, match, foreign in reversed(sections):
        own = F.when(F.col("line").contains(match), F.struct(F.lit(track).alias("track"), F.lit(foreign).alias("foreign"))).otherwise(own)
    order = Window.partitionBy("ref").orderBy("t", "r").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumn("own", own)
    return marked.withColumn("section", F.last("own", ignorenulls=True).over(order)).withColumn("is_header", F.col("own").isNotNull()).drop("own")


def sectioned_fees(lines: DataFrame, sections: list[tuple[str, str, bool]], aliases: DataFrame, fee_pattern: str, suffix: str) -> DataFrame:
    """(program_id, ref, value, segments, tracks): the first row that an alias pattern and the fee pattern meet, its section's last header row, and the native tracks of all such rows."""
    placed = in_sections(lines, sections)
    headers = placed.where("is_header").groupBy("ref", F.col("section.track").alias("track")).agg(F.max(F.struct("t", "r", "line")).alias("h")).select("ref", "track", F.col("h.line").alias("header"))
    fee = F.regexp_extract("line", fee_pattern, 1)
    hits = placed.withColumn("fee", fee).where("fee <> ''").join(aliases, "ref").where(F.regexp_like("line", F.col("alias_pattern")))
    per = hits.groupBy("program_id", "ref").agg(
        F.min(F.struct("t", "r", "fee", "line", F.col("section.track").alias("track"))).alias("h"),
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(~F.col("section.foreign"), F.struct("t", "r", F.col("section.track").alias("track"))))), lambda x: x["track"])).alias("tracks"),
    )
    joined = per.select("program_id", "ref", "h.*", "tracks").join(headers, ["ref", "track"], "left")
    return joined.select("program_id", "ref", F.concat_ws(" ", "fee", F.lit(suffix)).alias("value"), F.array_compact(F.array("header", "line")).alias("segments"), F.array_join("tracks", "; ").alias("tracks"))


def near_section(text: Column, section: Column, value_pattern: str, window: int = 120) -> Column:
    """The first value within `window` characters after a section's pattern, in a normed text."""
    found = extract(text, F.concat(F.lit("(?s)(?:"), section, F.lit(f").{{0,{window}}}?({value_pattern})")), 1)
    return F.when(found != "", norm(found))


def clause_of_row(layout: Column, alias: Column, row_template: str, group: int, clause_template: str | None = None, pick: str | None = None) -> Column:
    """A row found by an alias in a layout text; with a clause template, the bullet of the clause it names that holds `pick`, or its first."""
    row = extract(layout, _filled(row_template, alias, "(?ms)"), group)
    row = F.when(row != "", norm(row))
    if clause_template is None:
        return row
    clause = extract(layout, _filled(clause_template, alias, ""), 1)
    bullets = F.filter(F.transform(F.split(clause, r"\n?\s*-\s+"), norm), lambda x: x != "")
    chosen = F.try_element_at(F.filter(bullets, lambda x: F.contains(x, F.lit(pick))), F.lit(1)) if pick else F.lit(None)
    return F.coalesce(F.when(clause != "", F.coalesce(chosen, F.try_element_at(bullets, F.lit(1)))), row)


def _filled(template: str, alias: Column, flags: str) -> Column:
    parts = template.split("{alias}")
    out: list[Column] = [F.lit(flags + parts[0])]
    for p in parts[1:]:
        out += [quoted(alias), F.lit(p)]
    return F.concat(*out)


def sentence_value(text: Column, pattern: str, group: str, alias: Column, pad: int = 40) -> Column:
    """struct(value, segment) of a named group in the sentence a pattern finds; {alias} stands for the programme.

    The text is searched as it is.  Named groups are compiled to numbers on the
    driver, since the JVM writes them differently.
    """
    import re

    names = re.compile(pattern.replace("{alias}", "x")).groupindex
    if group not in names:
        raise ValueError(f"the pattern has no group {group}")
    plain = re.sub(r"\(\?P<\w+>", "(", pattern)
    found = extract(text, _filled(plain, alias, ""), names[group])
    around = extract(text, F.concat(F.lit(f"(?s)(.{{0,{pad}}}(?:"), _filled(plain, alias, ""), F.lit(f").{{0,{pad}}})")), 1)
    return F.when(found != "", F.struct(norm(found).alias("value"), norm(around).alias("segment")))


def tail_of_match(text: Column, pattern: str, alias: Column, size: int = 400) -> Column:
    """struct(value, segment): group 1 of a pattern, and the last `size` characters of what it matched."""
    found = extract(text, _filled(pattern, alias, ""), 1)
    whole = extract(text, _filled(pattern, alias, ""), 0)
    return F.when(found != "", F.struct(norm(found).alias("value"), F.substring(whole, F.greatest(F.length(whole) - size + 1, F.lit(1)), F.lit(size)).alias("segment")))
