"""Plans of what to fetch, records of what was fetched, and the fetch itself, which runs on the driver and only if asked for."""

import hashlib
import json
import time
import urllib.request
from pathlib import Path

from pyspark.sql import functions as F

from textloom.functions.text import slug

# For each source, its formats, addresses, file endings and the prefix of its folders.
FORMATS = {
    "project_gutenberg": {"txt": ("https://www.gutenberg.org/cache/epub/{id}/pg{id}.txt", ".txt"), "epub": ("https://www.gutenberg.org/ebooks/{id}.epub.noimages", ".epub")},
    "internet_archive": {"djvu_txt": ("https://archive.org/download/{id}/{id}_djvu.txt", ".txt")},
    "standard_ebooks": {"epub": ("https://standardebooks.org/ebooks/{id}/downloads/{slug}.epub?source=download", ".epub")},
}
PREFIX = {"project_gutenberg": "pg", "internet_archive": "ia", "standard_ebooks": "se"}


def plan(selected, source: str, formats=None, root: str = "raw"):
    """(version_id, format, url, folder, filename): a row for each selected version and format. An unknown format is an error."""
    known = FORMATS[source]
    formats = list(dict.fromkeys(formats or known))
    if unknown := [f for f in formats if f not in known]:
        raise ValueError(f"unknown formats: {', '.join(unknown)}")
    sid, vid = F.col("source_id").cast("string"), F.col("version_id").cast("string")

    def filled(template):
        parts = [F.lit(template)]
        out = parts[0]
        for name, value in (("{id}", sid), ("{slug}", slug(sid))):
            out = F.replace(out, F.lit(name), value)
        return out

    rows = F.array(*[F.struct(F.lit(f).alias("format"), filled(known[f][0]).alias("url"), F.concat(vid, F.lit(known[f][1])).alias("filename")) for f in formats])
    folder = F.concat(F.lit(f"{root}/{PREFIX[source]}_"), slug(sid) if source == "standard_ebooks" else sid, F.lit("_"), vid)
    return selected.select("version_id", F.explode(rows).alias("c"), folder.alias("folder")).select("version_id", "c.format", "c.url", "folder", "c.filename")


def to_fetch(planned, present, overwrite: bool = False):
    """Planned rows whose file isn't there yet. present: (folder, filename)."""
    return planned if overwrite else planned.join(present, ["folder", "filename"], "left_anti")


def audit(planned, present):
    """One row: planned files and folders, found ones, missing ones. present: (folder, filename)."""
    p = present.select("folder", "filename", F.lit(1).alias("found"))
    return planned.join(p, ["folder", "filename"], "left").agg(F.count("*").alias("planned"), F.count_distinct("folder").alias("folders"), F.count("found").alias("found"), F.sum(F.when(F.col("found").isNull(), 1).otherwise(0)).alias("missing"))


def outcomes(artifacts):
    """(status, n, bytes) of artifacts: downloaded, skipped_existing, failed."""
    return artifacts.groupBy("status").agg(F.count("*").alias("n"), F.coalesce(F.sum("byte_count"), F.lit(0)).alias("bytes"))


def fetch(rows, timeout: float = 60.0, pause: float = 0.5, agent: str = "textloom", overwrite: bool = False, opener=urllib.request.urlopen) -> list[dict]:
    """Fetches planned rows, one after the other, into their folders, and returns an artifact for each. For a driver with local folders; no query calls it."""
    out = []
    for r in rows:
        at = Path(r["folder"]) / r["filename"]
        entry = {"version_id": r["version_id"], "format": r["format"], "source_url": r["url"], "raw_path": str(at), "status": "skipped_existing"}
        if overwrite or not at.exists():
            at.parent.mkdir(parents=True, exist_ok=True)
            part, digest, size = at.with_name(at.name + ".part"), hashlib.sha256(), 0
            try:
                with opener(urllib.request.Request(r["url"], headers={"User-Agent": agent}), timeout=timeout) as response, part.open("wb") as f:
                    entry |= {"http_status": getattr(response, "status", None), "content_type": response.headers.get("Content-Type"), "content_length_header": response.headers.get("Content-Length")}
                    while data := response.read(1 << 20):
                        digest.update(data)
                        size += len(data)
                        f.write(data)
                part.replace(at)
                entry |= {"status": "downloaded", "byte_count": size, "sha256": digest.hexdigest()}
            except OSError as e:
                part.unlink(missing_ok=True)
                entry |= {"status": "failed", "error": str(e)}
            time.sleep(pause)
        out.append(entry)
    return out


def write_sidecar(record: dict, artifacts: list[dict], folder: str, acquired_at_utc: str) -> Path:
    """One file of what was acquired for a version, beside its artifacts, replaced as a whole."""
    keys = ("version_id", "work_id", "source", "source_id", "source_url", "license_status", "license_rationale")
    out = {**{k: record.get(k) for k in keys}, "acquired_at_utc": acquired_at_utc, "manifest_record": record, "artifacts": artifacts}
    at = Path(folder) / "metadata.json"
    at.parent.mkdir(parents=True, exist_ok=True)
    part = at.with_name("metadata.json.part")
    part.write_text(json.dumps(out, indent=2, sort_keys=True, ensure_ascii=False) + "\n", encoding="utf-8")
    return part.replace(at)
