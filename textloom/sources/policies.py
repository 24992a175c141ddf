"""Policy manifests in a small part of YAML: nested maps and lists of scalars by indentation."""

import json
import re


def parse(text: str):
    """Maps, lists of scalars and scalars; quoted strings, true, false, null and whole numbers. Anything else in a line is an error."""
    lines = [(len(x) - len(x.lstrip()), x.strip()) for x in text.splitlines() if x.strip() and not x.lstrip().startswith("#")]
    out, rest = _block(lines, 0, lines[0][0] if lines else 0)
    if rest != len(lines):
        raise ValueError(f"unexpected indentation: {lines[rest][1]}")
    return out


def _scalar(text: str):
    if text[:1] == '"':
        return json.loads(text)
    if text[:1] == "'":
        return text[1:-1].replace("''", "'")
    known = {"true": True, "false": False, "null": None, "~": None, "[]": [], "{}": {}}
    if text in known:
        return known[text]
    return int(text) if re.fullmatch(r"-?\d+", text) else text


def _block(lines, i: int, indent: int):
    if i < len(lines) and lines[i][1].startswith("- "):
        out = []
        while i < len(lines) and lines[i][0] == indent and lines[i][1].startswith("- "):
            out.append(_scalar(lines[i][1][2:].strip()))
            i += 1
        return out, i
    out = {}
    while i < len(lines) and lines[i][0] == indent:
        found = re.fullmatch(r"""("[^"]*"|'[^']*'|[^:]+):(?:\s+(.*))?""", lines[i][1])
        if not found:
            raise ValueError(f"not a key: {lines[i][1]}")
        key, value = str(_scalar(found[1])), found[2]
        i += 1
        if value:
            out[key] = _scalar(value)
        elif i < len(lines) and (lines[i][0] > indent or lines[i][0] == indent and lines[i][1].startswith("- ")):
            out[key], i = _block(lines, i, lines[i][0])
        else:
            out[key] = None
    return out, i


def licences(spark, text: str):
    """(license_status, include_by_default, description); include_by_default as include, exclude or review."""
    as_text = {True: "include", False: "exclude"}
    rows = [(k, as_text.get(v.get("include_by_default"), "review"), v.get("description")) for k, v in parse(text)["license_statuses"].items()]
    return spark.createDataFrame(rows, "license_status string, include_by_default string, description string")


def sources(spark, text: str):
    rows = [(k, v.get("priority"), v.get("role"), v.get("base_url"), v.get("acquisition_methods") or [], v.get("default_license_status"), v.get("notes")) for k, v in parse(text)["sources"].items()]
    return spark.createDataFrame(rows, "source string, priority int, role string, base_url string, acquisition_methods array<string>, default_license_status string, notes string")


def authors(spark, text: str):
    return spark.createDataFrame([(p, a) for p, names in parse(text)["authors"].items() for a in names or []], "period string, author string")
