"""Ragged report tables: header rows, column schema, carried context; recognised blocks in lines and columns."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What a header cell says, by field.
HEADER_FIELDS = (
    ("item", r"检测项目|检验项目|测试项目|项目名称|^项目$"), ("method", r"检测方法|试验方法|检验方法|标准方法|依据"), ("requirement", r"技术要求|标准.{0,3}值|限值|指标|^要求$"),
    ("result", r"检测结果|实测值|检验结果|测试结果|^结果$"), ("verdict", r"单项判定|单项结论|判定|结论|评定"), ("unit", r"单位"),
)
VERDICT = re.compile(r"^(?:不符合|不合格|不通过|符合|合格|通过)$")
ROWS = "url string, page int, table string, row int, parent string, child string, method string, requirement string, result string, verdict string, n_header int"
LINE_LEAST, LINE_SHARE = 0.008, 0.45


def header_columns(cells: list[str]) -> dict[str, list[int]]:
    """Columns of each field in a header row; empty unless it names a result or verdict and an item or requirement."""
    found: dict[str, list[int]] = {}
    for i, cell in enumerate(cells):
        bare = re.sub(r"\s+", "", cell or "")
        field = next((f for f, p in HEADER_FIELDS if bare and re.search(p, bare)), None)
        if field:
            found.setdefault(field, []).append(i)
    if not ({"result", "verdict"} & set(found) and {"item", "requirement"} & set(found)):
        return {}
    if "item" not in found:  # what stands before the first named column is the item
        first = min(min(x) for x in found.values())
        found["item"] = [0] if first else []
    return found


def joined_verdict(cells: list[str], column: int) -> str:
    """A verdict that was split over up to three cells to the left."""
    text = re.sub(r"\s+", "", cells[column] if column < len(cells) else "")
    for back in range(1, 4):
        if VERDICT.match(text) and not (text in ("合格", "符合") and column >= back and cells[column - back].strip() == "不"):
            break
        if column - back < 0:
            break
        left = re.sub(r"\s+", "", cells[column - back])
        if len(left) > 3 or not VERDICT.match(left + text) and len(left + text) > 3:
            break
        text = left + text
    return text if VERDICT.match(text) else ""


def _field(cells: list[str], columns: dict[str, list[int]], name: str) -> str:
    return " ".join(re.sub(r"\s+", "", cells[i]) for i in columns.get(name, ()) if i < len(cells) and cells[i].strip())


def carry_rows(table: pd.DataFrame) -> pd.DataFrame:
    """Rows of one table with what they inherit. A header row makes the columns and clears what is carried. The parent fills down;
    where it changes, method and verdict are the row's own, else own or carried. While a parent's verdict cell was merged over
    rows without results, rows with a result and no verdict are its children."""
    out, columns, n_header = [], {}, 0
    parent = method = verdict = ""
    merged = False
    for r in table.sort_values("row").itertuples():
        cells = [c or "" for c in r.cells]
        header = header_columns(cells)
        if header:
            columns, n_header = header, n_header + 1
            parent, method, verdict, merged = "", "", "", False
            continue
        if not columns or not any(c.strip() for c in cells):
            continue
        named = [re.sub(r"\s+", "", cells[i]) for i in columns["item"] if i < len(cells)]
        result, own_method, requirement = (_field(cells, columns, f) for f in ("result", "method", "requirement"))
        own_verdict = joined_verdict(cells, columns["verdict"][0]) if "verdict" in columns else ""
        forced = bool(parent and result and not own_verdict and merged)
        first, rest = (named[0] if named else ""), "".join(named[1:])
        new, child = (parent, first or rest) if forced or not first else (first, rest)
        if not new:
            continue
        changed = new != parent
        row_verdict, row_method = (own_verdict, own_method) if changed else (own_verdict or verdict, own_method or method)
        out.append((r.url, r.page, r.table, r.row, new, child, row_method, requirement, result, row_verdict, n_header))
        if changed:
            method, verdict = own_method, own_verdict
        else:
            method, verdict = own_method or method, own_verdict or verdict
        parent = new
        if own_verdict:
            merged = not result
    return pd.DataFrame(out, columns=[c.split()[0] for c in ROWS.split(", ")])


def table_rows(cells: DataFrame) -> DataFrame:
    """cells: url, page, table, row, cells (array of text). Item rows with carried context; one table is one group, which is as
    large as a page's table."""
    return cells.groupBy("url", "page", "table").applyInPandas(carry_rows, ROWS)


def visual_lines(blocks: pd.DataFrame) -> pd.DataFrame:
    """Lines of one page from its blocks, from top to bottom: a block begins a line if it is further from the line's mean height
    than LINE_SHARE of its own height, and than LINE_LEAST."""
    out, line, mean, number = [], [], 0.0, 0
    for b in blocks.dropna(subset=["mid_y"]).sort_values(["mid_y", "ord"], ascending=[False, True]).itertuples():
        if line and abs(b.mid_y - mean) > max(LINE_LEAST, LINE_SHARE * (b.height or 0)):
            out.append((number, " ".join(t for _, t in sorted(line))))
            line, number = [], number + 1
        line.append((b.mid_x, b.text))
        mean = b.mid_y if len(line) == 1 else mean + (b.mid_y - mean) / len(line)
    if line:
        out.append((number, " ".join(t for _, t in sorted(line))))
    return pd.DataFrame([(blocks["url"].iloc[0], blocks["page"].iloc[0], n, t) for n, t in out], columns=["url", "page", "line_no", "line"])


def blocks_to_lines(blocks: DataFrame) -> DataFrame:
    """blocks: url, page, ord, text, mid_x, mid_y, height."""
    return blocks.groupBy("url", "page").applyInPandas(visual_lines, "url string, page int, line_no int, line string")


def header_cluster(blocks: DataFrame, near: float = 0.05) -> DataFrame:
    """url, page, y: where the most header fields stand together; item, result and verdict together count five more."""
    field = F.lit(None).cast("string")
    for name, pattern in reversed(HEADER_FIELDS):
        field = F.when(F.regexp_replace("text", r"\s+", "").rlike(pattern), name).otherwise(field)
    heads = blocks.withColumn("field", field).filter("field is not null").select("url", "page", "field", "mid_y")
    around = heads.select("url", "page", F.col("mid_y").alias("y")).distinct().join(heads, ["url", "page"]).filter(F.abs(F.col("mid_y") - F.col("y")) <= near)
    score = around.groupBy("url", "page", "y").agg(F.collect_set("field").alias("f"))
    score = score.withColumn("score", F.size("f") + F.when(F.size(F.array_intersect("f", F.array(*map(F.lit, ("item", "result", "verdict"))))) == 3, 5).otherwise(0))
    return score.groupBy("url", "page").agg(F.max_by("y", F.struct("score", "y")).alias("y"))


def band_rows(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """Blocks with the sequence number whose band they lie in: half-open, from the midpoint to the anchor above to the one below.
    anchors: url, page, seq, y."""
    w = W.partitionBy("url", "page").orderBy(F.desc("y"), "seq")
    bands = anchors.withColumn("upper", F.coalesce((F.col("y") + F.lag("y").over(w)) / 2, F.lit(float("inf")))).withColumn("lower", F.coalesce((F.col("y") + F.lead("y").over(w)) / 2, F.lit(float("-inf"))))
    return blocks.join(bands.select("url", "page", "seq", "lower", "upper"), ["url", "page"]).filter("lower < mid_y and mid_y <= upper").drop("lower", "upper")
