"""Instance documents: facts of chosen tags with their share class."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAGS = (
    "EntityCommonStockSharesOutstanding", "CommonStockSharesOutstanding", "EarningsPerShareBasic", "EarningsPerShareDiluted",
    "WeightedAverageNumberOfSharesOutstandingBasic",
)


def _local(name: str) -> str:
    return name.rpartition("}")[2]


def facts_of(xml: str | None, tags: tuple[str, ...] = TAGS) -> list[tuple[str, str, float, str | None, str | None]]:
    """(tag, member, value, start, end) of facts whose context has no
    dimension or only that of the share class. Text that is no XML, and
    values that are no numbers, give nothing."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return []
    contexts, found = {}, []
    for node in root.iter():
        name = _local(node.tag)
        if name == "context":
            members = [(m.get("dimension") or "", (m.text or "").strip()) for m in node.iter() if _local(m.tag) == "explicitMember"]
            dates = {_local(d.tag): (d.text or "").strip() for d in node.iter() if _local(d.tag) in ("instant", "startDate", "endDate")}
            if all("ClassOfStock" in d for d, _ in members):
                start = None if "instant" in dates else dates.get("startDate")
                contexts[node.get("id")] = (members[0][1] if members else "", start, dates.get("instant") or dates.get("endDate"))
        elif name in tags and node.get("contextRef"):
            try:
                found.append((name, node.get("contextRef"), float((node.text or "").strip())))
            except ValueError:
                continue
    rows = ((tag, contexts[ref][0], value, *contexts[ref][1:]) for tag, ref, value in found if ref in contexts)
    return list(dict.fromkeys(rows))


def instance_facts(documents: DataFrame) -> DataFrame:
    """Rows of ``facts_of`` for documents (accession, form, filed, xml)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            accession, rows = [], []
            for key, xml in zip(batch["accession"].to_pylist(), batch["xml"].to_pylist()):
                new = facts_of(xml)
                accession += [key] * len(new)
                rows += new
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.float64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(accession, pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["accession", "tag", "member", "value", "start", "end"],
            )

    parsed = documents.select("accession", "xml").mapInArrow(run, "accession string, tag string, member string, value double, start string, end string")
    dated = parsed.select("accession", "tag", "member", "value", F.try_to_date("start").alias("period_start"), F.try_to_date("end").alias("period_end"))
    return dated.join(documents.select("accession", "form", "filed").dropDuplicates(["accession"]), "accession")
