"""Notices as XML: one pass over a document for all wanted paths, whatever the namespaces, and bulk files by row tag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Where the two forms of a notice hold their fields. A path names elements below one another, others may stand between.
FORM_PATHS = {
    "project_id": ("ProcurementProject", "ID"), "documents_uri": ("CallForTendersDocumentReference", "Attachment", "ExternalReference", "URI"), "tools_uri": ("TenderingProcess", "AccessToolsURI"), "profile_uri": ("ContractingParty", "BuyerProfileURI"),
    "endpoint": ("TenderRecipientParty", "EndpointID"), "folder_id": ("ContractFolderID",), "url_document": ("URL_DOCUMENT",), "url_participation": ("URL_PARTICIPATION",), "url_buyer": ("URL_BUYER",), "ia_url_general": ("IA_URL_GENERAL",), "url_general": ("URL_GENERAL",), "no_doc_ojs": ("NO_DOC_OJS",),
}
# Parts of a profile's address that make it a link to the documents.
DEEP_LINKS = ("/vz", "?id=", "/pn/", "/notice", "/profil/")
EXPORT_ROOT = "TED_EXPORT"


class _Paths:
    """Collects, in one pass, the first text that isn't blank at each path; a text is what stands before the first child."""

    def __init__(self, paths: Mapping[str, Sequence[str]]):
        self.paths, self.found = list(paths.items()), {}
        self.root, self.attributes, self.first_id, self.depth = None, {}, None, 0
        self.held: list[list[int]] = [[0] * len(self.paths)]  # by depth: how many names of each path are above
        self.open: list[str] = []  # names of paths whose text is being read
        self.text: list[str] | None = None
        self.is_first_id = False

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        self.close()
        name = tag.rsplit("}", 1)[-1]
        if self.root is None:
            self.root, self.attributes = name, {k.rsplit("}", 1)[-1]: v for k, v in attributes.items()}
        self.depth += 1
        now, above = [], self.held[-1]
        for (field, path), k in zip(self.paths, above, strict=True):
            if k < len(path) and path[k] == name:
                k += 1
                if k == len(path) and field not in self.found:
                    self.open.append(field)
            now.append(k)
        self.held.append(now)
        self.is_first_id = self.depth == 2 and name == "ID" and self.first_id is None
        if self.is_first_id:
            self.first_id = ""
        if self.open or self.is_first_id:
            self.text = []

    def characters(self, data: str) -> None:
        if self.text is not None:
            self.text.append(data)

    def close(self) -> None:
        """The text of the element that was opened last ends."""
        if self.text is not None:
            value = "".join(self.text).strip()
            if value:
                self.found.update(dict.fromkeys(self.open, value))
                if self.is_first_id:
                    self.first_id = value
        self.open, self.text, self.is_first_id = [], None, False

    def end(self, _: str) -> None:
        self.close()
        self.held.pop()
        self.depth -= 1


def parsed(xml: str | bytes | None, paths: Mapping[str, Sequence[str]] = FORM_PATHS) -> dict[str, str | None]:
    """``root, first_id, doc_id`` and the text at each path; nothing at all of a document that is no XML."""
    if not xml:
        return {}
    seen = _Paths(paths)
    parser = expat.ParserCreate(namespace_separator="}")
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = seen.start, seen.end, seen.characters
    try:
        parser.Parse(xml, True)
    except expat.ExpatError:
        return {}
    return {"root": seen.root, "first_id": seen.first_id or None, "doc_id": seen.attributes.get("DOC_ID") or None, **seen.found}


def xml_texts(xml: Column, paths: Mapping[str, Sequence[str]] = FORM_PATHS) -> Column:
    """A struct of ``root, first_id, doc_id`` and a text for each path, by one pass over each document."""
    names = ["root", "first_id", "doc_id", *paths]

    @F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    def run(documents: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parsed(d, paths) for d in documents], columns=names, dtype=object).astype(object).where(lambda x: x.notna(), None)

    return run(xml)


def _with_scheme(url: Column) -> Column:
    u = F.nullif(F.trim(url), F.lit(""))
    return F.when(u.startswith("http://") | u.startswith("https://"), u).otherwise(F.concat(F.lit("https://"), u))


def notice_fields(df: DataFrame, xml: str) -> DataFrame:
    """Adds ``internal_reference, tender_documents_access, buyer_profile_url_full, submit_tenders_endpoint, contract_folder_id, notice_uuid, no_doc_ojs``.

    Of both forms of notices: the older export by its own elements, any other root
    as the newer form. Documents that are null or no XML have nulls.
    """
    d = df.withColumn("_x", xml_texts(F.col(xml)))
    x = lambda name: F.col(f"_x.{name}")
    old = x("root") == EXPORT_ROOT
    either = lambda legacy, new: F.when(old, legacy).otherwise(new)
    profile = _with_scheme(either(F.coalesce(x("url_buyer"), x("ia_url_general"), x("url_general")), x("profile_uri")))
    deep = F.coalesce(*(F.when(profile.contains(s), profile) for s in DEEP_LINKS))
    documents = either(_with_scheme(F.coalesce(x("url_document"), x("url_participation"))), F.coalesce(_with_scheme(F.coalesce(x("documents_uri"), x("tools_uri"))), deep))
    out = {
        "internal_reference": either(F.lit(None), x("project_id")), "tender_documents_access": documents, "buyer_profile_url_full": profile, "submit_tenders_endpoint": _with_scheme(either(x("url_participation"), x("endpoint"))),
        "contract_folder_id": either(F.lit(None), x("folder_id")), "notice_uuid": either(x("doc_id"), x("first_id")), "no_doc_ojs": either(x("no_doc_ojs"), F.lit(None)),
    }
    return d.withColumns({k: v.cast("string") for k, v in out.items()}).drop("_x")


_COMPANY = "struct<Company:struct<PartyName:array<struct<Name:string>>>>"
_BULK = f"ContractFolderID string, IssueDate string, ProcurementProject struct<Name:string,Description:string>, UBLExtensions struct<UBLExtension:array<struct<ExtensionContent:struct<EformsExtension:struct<Organizations:struct<Organization:array<{_COMPANY}>>>>>>>"


def bulk_notices(spark: SparkSession, paths: str | Sequence[str], row_tag: str = "ContractNotice") -> DataFrame:
    """``notice_id, title, authority, published, description`` of each notice of bulk files, which Spark splits at the row tag.

    The authority is the first organisation that has a company name. Notices without an id are left out.
    """
    rows = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True).schema(_BULK).load(list(paths) if not isinstance(paths, str) else paths)
    organisations = F.flatten(F.transform("UBLExtensions.UBLExtension", lambda e: F.coalesce(e["ExtensionContent"]["EformsExtension"]["Organizations"]["Organization"], F.array().cast(f"array<{_COMPANY}>"))))
    named = F.filter(F.transform(organisations, lambda o: F.trim(F.get(o["Company"]["PartyName"], F.lit(0))["Name"])), lambda n: n.isNotNull())
    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    return rows.select(text("ContractFolderID").alias("notice_id"), text("ProcurementProject.Name").alias("title"), F.get(named, F.lit(0)).alias("authority"), F.left("IssueDate", F.lit(10)).alias("published"), text("ProcurementProject.Description").alias("description")).where("notice_id IS NOT NULL")
