"""A small collection for the tests: one record for each case, as objects, JSON files and XML files.

jar    one child in every wrapper, all rules hold
rug    several children everywhere; contributors without birth year or nationality
mask   no date (a comment in its place), an empty contributors' wrapper
oar    the second dimension is below 1
bell   nobody is an artist; a term that the terminology lacks; "Sculpture" without depth
kite   no primary image, a plain http address, a contributor born after the date
lamp   no height, a unit other than cm
"""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from pathlib import Path

TERMS = [("material", "axis", "Material"), ("use", "axis", "Use"), ("clay", "material", "Fired clay"),
         ("reed", "material", "Split reed"), ("brass", "material", "Cast <brass>"), ("feast", "use", "Feast days"),
         ("hill", "nationality", "Hill people"), ("shore", "nationality", "Shore & isles")]


def who(name, role="artist", born=None, people=None):
    return {"name": name, "role": role, "birth_year": born, "nationality_id": people}


def size(kind, value, unit="cm"):
    return {"type": kind, "value": value, "unit": unit}


def image(kind, url, caption):
    return {"type": kind, "url": url, "caption": caption}


def record(object_id, date, department, people, refs, sizes, images):
    return {"object_id": object_id, "title": f"The {object_id}", "date_made": date, "credit_line": f"Gift no. {len(object_id)}",
            "department": department, "constituents": people,
            "classification_ids": [{"type_id": a, "term_id": b} for a, b in refs], "dimensions": sizes, "media": images}


OBJECTS = [
    record("jar", 1931, "Vessels", [who("Ada", born=1899, people="hill")], [("material", "clay")], [size("height", 12.0)],
           [image("primary", "https://pics.test/jar", "Front")]),
    record("rug", 1887, "Weaving",
           [who("Bo"), who("Cy & Sons", "donor"), who("Di", born=1850, people="shore"), who("Ed", "dyer", 1861)],
           [("use", "feast"), ("material", "reed")], [size("width", 90.5), size("height", 140.0)],
           [image("detail", "https://pics.test/rug/2", "Knots"), image("primary", "https://pics.test/rug/1", 'The "whole"')]),
    record("mask", None, "Weaving", [], [("material", "reed")], [size("height", 31.0)],
           [image("primary", "https://pics.test/mask", "Left side")]),
    record("oar", 1902, "Boats", [who("Flo", born=1870, people="shore")], [("use", "feast")],
           [size("height", 210.0), size("depth", 0.25)], [image("primary", "https://pics.test/oar", "Blade")]),
    record("bell", 1790, "Sculpture", [who("Gus", "founder", 1755, "hill")], [("material", "brass"), ("use", "gone")],
           [size("height", 44.0)], [image("primary", "https://pics.test/bell", "Rim")]),
    record("kite", 1940, "Toys", [who("Hal", born=1950)], [("use", "feast")], [size("height", 70.0)],
           [image("detail", "http://pics.test/kite", "Tail")]),
    record("lamp", 1922, "Vessels", [who("Ivy", born=1880, people="hill")], [("material", "clay")], [size("depth", 9.0, "in")],
           [image("primary", "https://pics.test/lamp", "Lit")]),
]


def object_xml(o: dict) -> str:
    """One object document: the root's attribute id, a wrapper element for each list, absent values left out."""
    root = ET.Element("object", id=o["object_id"])

    def leaf(parent, name, value):
        if value is not None:
            ET.SubElement(parent, name).text = str(value)

    leaf(root, "title", o["title"])
    if o["date_made"] is None:
        root.append(ET.Comment("undated"))
    for name in ("date_made", "credit_line", "department"):
        leaf(root, name, o[name])
    people = ET.SubElement(root, "constituents")
    for c in o["constituents"]:
        person = ET.SubElement(people, "constituent", role=c["role"])
        for name in ("name", "birth_year", "nationality_id"):
            leaf(person, name, c[name])
    for wrapper, child, rows in (("classifications", "classification", o["classification_ids"]),
                                 ("dimensions", "dimension", o["dimensions"])):
        box = ET.SubElement(root, wrapper)
        for r in rows:
            ET.SubElement(box, child, {k: str(v) for k, v in r.items()})
    images = ET.SubElement(root, "media")
    for m in o["media"]:
        shown = ET.SubElement(images, "image", type=m["type"])
        leaf(shown, "url", m["url"])
        leaf(shown, "caption", m["caption"])
    ET.indent(root)
    return ET.tostring(root, encoding="unicode", xml_declaration=False) + "\n"


def terminology_xml() -> str:
    root = ET.Element("terminology")
    for term, kind, label in TERMS:
        ET.SubElement(root, "term", id=term, type=kind).text = label
    return ET.tostring(root, encoding="unicode")


def write_fixture(root: Path) -> dict[str, str]:
    """Write the XML and JSON forms; returns their paths."""
    objects = root / "xml" / "objects"
    objects.mkdir(parents=True)
    for o in OBJECTS:
        (objects / f"{o['object_id']}.xml").write_text(object_xml(o))
    paths = {"xml_objects": objects, "xml_terms": root / "xml" / "terms.xml", "json_objects": root / "objects.json",
             "json_terms": root / "terms.json"}
    paths["xml_terms"].write_text(terminology_xml())
    paths["json_objects"].write_text(json.dumps(OBJECTS, indent=1))
    paths["json_terms"].write_text(json.dumps([dict(zip(("term_id", "term_type", "label"), t)) for t in TERMS]))
    return {k: str(p) for k, p in paths.items()}
