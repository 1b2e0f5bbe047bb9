"""Diagrams: JSON of one drawing tool to rows and to the XML of another, and back; comparison by joins."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.config import DEFAULT

# Kinds by what a shape's id holds, the first that fits.
SHAPE_KINDS = [("ellipse", "ellipse"), ("circle", "ellipse"), ("diamond", "diamond"), ("decision", "diamond"), ("database", "cylinder"), ("cylinder", "cylinder"), ("actor", "actor"), ("user", "actor"), ("cloud", "cloud"), ("note", "note"), ("round", "rounded"), ("rectangle", "rect"), ("square", "rect")]
#: shapes with an outline of their own: left, right, top, bottom, middles and quarters
OUTLINES = {
    "diamond": "M {cx} {t} L {r} {cy} L {cx} {b} L {l} {cy} Z",
    "cylinder": "M {l} {u} A {hw} {q} 0 0 1 {r} {u} L {r} {d} A {hw} {q} 0 0 1 {l} {d} Z M {l} {u} A {hw} {q} 0 0 0 {r} {u}",
    "actor": "M {cx} {u} L {cx} {d} M {l} {cy} L {r} {cy} M {cx} {d} L {l} {b} M {cx} {d} L {r} {b} M {cx} {t} A {q} {q} 0 0 1 {cx} {u}",
}
NODE = "id string, kind string, x double, y double, w double, h double, rotation double, text string, fill string, stroke string, stroke_width double, dash string, opacity double"
EDGE = "id string, points array<struct<x:double,y:double>>, stroke string, stroke_width double, dash string, start_arrow boolean, end_arrow boolean"


def shape_kind(tid: Column) -> Column:
    out = None
    for part, kind in SHAPE_KINDS:
        hit = F.contains(F.lower(tid), F.lit(part))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("rect")


def _kind(tid: str) -> str:
    return next((k for part, k in SHAPE_KINDS if part in (tid or "").lower()), "rect")


def _plain(markup: str) -> str:
    return re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", markup or ""))).strip()


def _dash(value: str | None) -> str:
    return " ".join(re.findall(r"\d+(?:\.\d+)?", value or ""))


def parse_stage(text: str) -> tuple[list[dict], list[dict]]:
    """(nodes, edges) of a drawing in JSON: positions are added up along the nesting, objects taken in drawing order, ids numbered."""
    stage = json.loads(text).get("stage", {})
    nodes: list[dict] = []
    edges: list[dict] = []

    def walk(objects: list, dx: float, dy: float) -> None:
        for o in sorted(objects or [], key=lambda o: int(o.get("order") or 0)):
            x, y = float(o.get("x") or 0) + dx, float(o.get("y") or 0) + dy
            graphic = o.get("graphic") or {}
            kind = graphic.get("type", "")
            if kind == "Line":
                line = graphic.get("Line", {})
                points = [{"x": x + float(px), "y": y + float(py)} for px, py in line.get("controlPath") or []]
                edges.append({
                    "id": f"e{len(edges):04d}", "points": points, "stroke": (line.get("strokeColor") or "#000000").lower(), "stroke_width": float(line.get("strokeWidth") or 1), "dash": _dash(line.get("dashStyle")),
                    "start_arrow": bool(line.get("startArrow")), "end_arrow": bool(line.get("endArrow")),
                })
            elif kind:
                shape = graphic.get(kind, {})
                label = _plain(shape.get("html", "")) or next((_plain(c["graphic"]["Text"].get("html", "")) for c in o.get("children") or [] if (c.get("graphic") or {}).get("type") == "Text"), "")
                nodes.append({
                    "id": f"n{len(nodes):04d}", "kind": {"Text": "text", "Image": "image", "Svg": "svg"}.get(kind) or _kind(shape.get("tid", o.get("uid", ""))), "x": x, "y": y, "w": float(o.get("width") or 0), "h": float(o.get("height") or 0),
                    "rotation": float(o.get("rotation") or 0), "text": label, "fill": (shape.get("fillColor") or "none").lower(), "stroke": (shape.get("strokeColor") or "#000000").lower(), "stroke_width": float(shape.get("strokeWidth") or 1), "dash": _dash(shape.get("dashStyle")), "opacity": float(shape.get("opacity") or 1),
                })
            rest = [c for c in o.get("children") or [] if not (kind == "Shape" and (c.get("graphic") or {}).get("type") == "Text")]
            walk(rest, x, y)

    walk(stage.get("objects"), 0.0, 0.0)
    return nodes, edges


def _style(parts: dict) -> str:
    return ";".join(f"{k}={v}" for k, v in parts.items()) + ";"


def emit_xml(nodes: list[dict], edges: list[dict]) -> str:
    """The drawing as flat cells of an mxGraph model."""
    root = ElementTree.Element("mxGraphModel")
    cells = ElementTree.SubElement(root, "root")
    for i in ("0", "1"):
        ElementTree.SubElement(cells, "mxCell", {"id": i} | ({"parent": "0"} if i == "1" else {}))
    for n in nodes:
        style = {"shape": n["kind"], "rotation": n["rotation"], "fillColor": n["fill"], "strokeColor": n["stroke"], "strokeWidth": n["stroke_width"], "dashPattern": n["dash"].replace(" ", "_"), "opacity": n["opacity"] * 100}
        cell = ElementTree.SubElement(cells, "mxCell", {"id": n["id"], "value": n["text"], "style": _style(style), "vertex": "1", "parent": "1"})
        ElementTree.SubElement(cell, "mxGeometry", {"x": repr(n["x"]), "y": repr(n["y"]), "width": repr(n["w"]), "height": repr(n["h"]), "as": "geometry"})
    for e in edges:
        style = {"strokeColor": e["stroke"], "strokeWidth": e["stroke_width"], "dashPattern": e["dash"].replace(" ", "_"), "startArrow": "block" if e["start_arrow"] else "none", "endArrow": "block" if e["end_arrow"] else "none"}
        cell = ElementTree.SubElement(cells, "mxCell", {"id": e["id"], "style": _style(style), "edge": "1", "parent": "1"})
        geo = ElementTree.SubElement(cell, "mxGeometry", {"relative": "1", "as": "geometry"})
        points = ElementTree.SubElement(geo, "Array", {"as": "points"})
        for p in e["points"]:
            ElementTree.SubElement(points, "mxPoint", {"x": repr(p["x"]), "y": repr(p["y"])})
    return ElementTree.tostring(root, encoding="unicode")


def parse_xml(text: str) -> tuple[list[dict], list[dict]]:
    """(nodes, edges) of an mxGraph model."""
    nodes, edges = [], []
    for cell in ElementTree.fromstring(text).iter("mxCell"):
        style = dict(p.split("=", 1) for p in (cell.get("style") or "").split(";") if "=" in p)
        geo = cell.find("mxGeometry")
        common = {"id": cell.get("id"), "stroke": style.get("strokeColor", "#000000").lower(), "stroke_width": float(style.get("strokeWidth", 1)), "dash": style.get("dashPattern", "").replace("_", " ")}
        if cell.get("vertex") == "1" and geo is not None:
            nodes.append(common | {
                "kind": style.get("shape", "rect"), "x": float(geo.get("x", 0)), "y": float(geo.get("y", 0)), "w": float(geo.get("width", 0)), "h": float(geo.get("height", 0)), "rotation": float(style.get("rotation", 0)),
                "text": cell.get("value", ""), "fill": style.get("fillColor", "none").lower(), "opacity": float(style.get("opacity", 100)) / 100,
            })
        elif cell.get("edge") == "1":
            points = [{"x": float(p.get("x", 0)), "y": float(p.get("y", 0))} for p in cell.iter("mxPoint")]
            edges.append(common | {"points": points, "start_arrow": style.get("startArrow", "none") != "none", "end_arrow": style.get("endArrow", "classic") != "none"})
    return nodes, edges


def render_svg(nodes: list[dict], edges: list[dict]) -> str:
    """A plain picture: boxes, ellipses, lines and labels."""
    w = max([n["x"] + n["w"] for n in nodes] + [p["x"] for e in edges for p in e["points"]] + [1])
    h = max([n["y"] + n["h"] for n in nodes] + [p["y"] for e in edges for p in e["points"]] + [1])
    out = [f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {w:g} {h:g}">']
    for n in nodes:
        paint = f'fill="{n["fill"]}" stroke="{n["stroke"]}" stroke-width="{n["stroke_width"]:g}"' + (f' stroke-dasharray="{n["dash"]}"' if n["dash"] else "")
        cx, cy = n["x"] + n["w"] / 2, n["y"] + n["h"] / 2
        if n["kind"] == "ellipse":
            out.append(f'<ellipse cx="{cx:g}" cy="{cy:g}" rx="{n["w"] / 2:g}" ry="{n["h"] / 2:g}" {paint}/>')
        elif n["kind"] in OUTLINES:
            x, y, w, h = n["x"], n["y"], n["w"], n["h"]
            corners = {"l": x, "r": x + w, "t": y, "b": y + h, "cx": cx, "cy": cy, "u": y + h / 4, "d": y + h * 3 / 4, "hw": w / 2, "q": h / 4}
            out.append(f'<path d="{OUTLINES[n["kind"]].format(**{k: format(v, "g") for k, v in corners.items()})}" {paint}/>')
        elif n["kind"] != "text":
            out.append(f'<rect x="{n["x"]:g}" y="{n["y"]:g}" width="{n["w"]:g}" height="{n["h"]:g}" rx="{8 if n["kind"] == "rounded" else 0}" {paint}/>')
        if n["text"]:
            out.append(f'<text x="{cx:g}" y="{cy:g}" text-anchor="middle">{html.escape(n["text"])}</text>')
    for e in edges:
        points = " ".join(f"{p['x']:g},{p['y']:g}" for p in e["points"])
        out.append(f'<polyline points="{points}" fill="none" stroke="{e["stroke"]}" stroke-width="{e["stroke_width"]:g}"/>')
    return "".join(out) + "</svg>"


def parse_diagrams(rows: DataFrame) -> DataFrame:
    """(source, nodes, edges, error) of rows (source, text): JSON drawings or mxGraph XML, told by the first character."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for source, text in zip(pdf["source"], pdf["text"]):
                try:
                    nodes, edges = parse_xml(text) if text.lstrip().startswith("<") else parse_stage(text)
                    out.append((source, nodes, edges, None))
                except Exception as e:  # noqa: BLE001 - one bad drawing is a row
                    out.append((source, [], [], f"{type(e).__name__}: {e}"))
            if out:
                yield pd.DataFrame(out, columns=["source", "nodes", "edges", "error"])

    def struct(s: str) -> str:
        return "array<struct<" + re.sub(r"(\w+) (array<struct<[^>]*>>|\w+)", r"\1:\2", s) + ">>"

    return rows.select("source", "text").mapInPandas(run, f"source string, nodes {struct(NODE)}, edges {struct(EDGE)}, error string")


def diagram_metrics(diagrams: DataFrame) -> DataFrame:
    """(source, kind, n): nodes by kind, and edges."""
    nodes = diagrams.select("source", F.explode("nodes.kind").alias("kind"))
    return nodes.unionByName(diagrams.select("source", F.explode(F.transform("edges", lambda e: F.lit("edge"))).alias("kind"))).groupBy("source", "kind").agg(F.count("*").alias("n"))


def compare(a: DataFrame, b: DataFrame, tolerance: float = DEFAULT.diagram_tolerance) -> DataFrame:
    """(source, part, id, field): what differs between two parses. Numbers may differ by the tolerance; an
    id on one side only is '<missing>' or '<extra>'."""

    def diffs(part: str, schema: str) -> DataFrame:
        x = a.select("source", F.inline(part)).withColumn("_a", F.lit(True))
        y = b.select("source", F.inline(part)).withColumn("_b", F.lit(True))
        names = [(n, t) for n, t in x.drop("source", "_a", "id").dtypes]
        y = y.select("source", "id", "_b", *[F.col(n).alias(f"{n}_2") for n, _ in names])
        j = x.join(y, ["source", "id"], "full_outer")
        found = [F.when(F.col("_b").isNull(), F.lit("<missing>")), F.when(F.col("_a").isNull(), F.lit("<extra>"))]
        both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
        for n, t in names:
            one, two = F.col(n), F.col(f"{n}_2")
            if t == "double":
                same = F.abs(one - two) <= tolerance
            elif t.startswith("array"):
                near = F.forall(F.zip_with(one, two, lambda p, q: (F.abs(p["x"] - q["x"]) <= tolerance) & (F.abs(p["y"] - q["y"]) <= tolerance)), lambda ok: ok)
                same = (F.size(one) == F.size(two)) & near
            else:
                same = one.eqNullSafe(two)
            found.append(F.when(both & ~F.coalesce(same, F.lit(False)), F.lit(n)))
        return j.select("source", F.lit(part).alias("part"), "id", F.explode(F.array_compact(F.array(*found))).alias("field"))

    return diffs("nodes", NODE).unionByName(diffs("edges", EDGE))


def round_trip(rows: DataFrame) -> DataFrame:
    """Differences after a drawing was emitted as XML and read again; none if the pair is faithful."""
    parsed = parse_diagrams(rows).where("error is null")

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"source": pdf["source"], "text": [emit_xml(list(n), list(e)) for n, e in zip(pdf["nodes"], pdf["edges"])]})

    return compare(parsed, parse_diagrams(parsed.select("source", "nodes", "edges").mapInPandas(emit, "source string, text string")))


def rendered(diagrams: DataFrame) -> DataFrame:
    """(source, svg) of parsed drawings (source, nodes, edges)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["source"]].assign(svg=[render_svg(list(n), list(e)) for n, e in zip(pdf["nodes"], pdf["edges"])])

    return diagrams.select("source", "nodes", "edges").mapInPandas(run, "source string, svg string")


def preferring_siblings(pictures: DataFrame, siblings: DataFrame) -> DataFrame:
    """(source, svg): the picture that stands beside a drawing under the same name, else the rendered one.

    ``siblings``: source, svg of files; the name is the path without its ending.
    """
    def stem(c: str) -> Column:
        return F.regexp_replace(c, r"\.[^./]*$", "")

    beside = siblings.where(F.col("svg").contains("<svg")).groupBy(stem("source").alias("_stem")).agg(F.min("svg").alias("_beside"))
    rows = pictures.withColumn("_stem", stem("source")).join(beside, "_stem", "left")
    return rows.select("source", F.coalesce("_beside", "svg").alias("svg"))
