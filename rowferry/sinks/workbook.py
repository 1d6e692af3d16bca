"""Workbook shards: row XML made by Spark, packed into XLSX or ODS files by the tasks."""

from __future__ import annotations

import json
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql.datasource import DataSource

from rowferry.sinks.shards import ShardWriter, text_bytes

# Fixed values of the public XLSX and ODS formats: rows per sheet, part names, name spaces,
# the three date formats.
SHEET_ROWS = 1_048_575
SHEET_COLUMNS = 16_384
DATE_FORMATS = {"date": "yyyy-mm-dd", "datetime": "yyyy-mm-ddThh:mm:ss", "time": "hh:mm:ss"}
STYLE_IDS = {"date": 1, "datetime": 2, "time": 3}
XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE_RELATIONS = "http://schemas.openxmlformats.org/package/2006/relationships"
CONTENT_TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
SHEET_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
ODS_TYPE = "application/vnd.oasis.opendocument.spreadsheet"
ODS_NAMESPACES = " ".join(
    f'xmlns:{short}="urn:oasis:names:tc:opendocument:xmlns:{long}:1.0"'
    for short, long in (("office", "office"), ("table", "table"), ("text", "text"),
                        ("manifest", "manifest"), ("style", "style"), ("number", "datastyle"))
)


class Workbook(DataSource):
    """Write a one-column frame of row XML; options format (xlsx or ods), columns, kinds."""

    @classmethod
    def name(cls):
        return "rowferry_workbook"

    def writer(self, schema, overwrite):
        kind = XlsxWriter if self.options["kind"] == "xlsx" else OdsWriter
        return kind(dict(self.options), overwrite)


class WorkbookWriter(ShardWriter):
    def __init__(self, options, overwrite):
        super().__init__(options, overwrite)
        self.max_rows = min(self.max_rows or SHEET_ROWS, SHEET_ROWS)
        self.columns = json.loads(options["columns"])
        self.styles = json.loads(options["styles"])

    def open_shard(self, stream):
        return WorkbookShard(self, stream)


class WorkbookShard:
    def __init__(self, book: WorkbookWriter, stream):
        self.book = book
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
        for name, content, method in book.static_parts():
            self.zip.writestr(name, content, compress_type=method)
        self.sheet = self.zip.open(book.sheet_part, "w", force_zip64=True)
        self.sheet.write(book.head().encode())

    def add(self, batch):
        self.sheet.write(memoryview(text_bytes(batch.column(0), b"")))

    def close(self):
        self.sheet.write(self.book.tail.encode())
        self.sheet.close()
        self.zip.close()


class XlsxWriter(WorkbookWriter):
    extension = ".xlsx"
    sheet_part = "xl/worksheets/sheet1.xml"
    tail = "</sheetData></worksheet>"

    def static_parts(self):
        formats = "".join(
            f'<numFmt numFmtId="{163 + STYLE_IDS[k]}" formatCode="{f}"/>'
            for k, f in DATE_FORMATS.items()
        )
        styles = "".join(
            f'<xf numFmtId="{163 + STYLE_IDS[k]}" fontId="0" fillId="0" borderId="0" xfId="0"'
            ' applyNumberFormat="1"/>'
            for k in DATE_FORMATS
        )
        plain = '<xf numFmtId="0" fontId="0" fillId="0" borderId="0"'
        parts = {
            "[Content_Types].xml": f'<Types xmlns="{CONTENT_TYPES}">'
            '<Default Extension="rels" ContentType='
            '"application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{SHEET_TYPE}.sheet.main+xml"/>'
            f'<Override PartName="/{self.sheet_part}" ContentType="{SHEET_TYPE}.worksheet+xml"/>'
            f'<Override PartName="/xl/styles.xml" ContentType="{SHEET_TYPE}.styles+xml"/></Types>',
            "_rels/.rels": f'<Relationships xmlns="{PACKAGE_RELATIONS}"><Relationship Id="rId1"'
            f' Type="{OFFICE_RELATIONS}/officeDocument" Target="xl/workbook.xml"/>'
            "</Relationships>",
            "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{OFFICE_RELATIONS}"><sheets>'
            '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE_RELATIONS}">'
            f'<Relationship Id="rId1" Type="{OFFICE_RELATIONS}/worksheet"'
            ' Target="worksheets/sheet1.xml"/>'
            f'<Relationship Id="rId2" Type="{OFFICE_RELATIONS}/styles" Target="styles.xml"/>'
            "</Relationships>",
            "xl/styles.xml": f'<styleSheet xmlns="{MAIN}"><numFmts count="3">{formats}</numFmts>'
            '<fonts count="1"><font><sz val="11"/><name val="Calibri"/></font></fonts>'
            '<fills count="2"><fill><patternFill patternType="none"/></fill>'
            '<fill><patternFill patternType="gray125"/></fill></fills>'
            '<borders count="1"><border><left/><right/><top/><bottom/><diagonal/></border>'
            f'</borders><cellStyleXfs count="1">{plain}/></cellStyleXfs>'
            f'<cellXfs count="4">{plain} xfId="0"/>{styles}</cellXfs></styleSheet>',
        }
        return [(n, XML + content, zipfile.ZIP_DEFLATED) for n, content in parts.items()]

    def head(self):
        columns = "".join(
            f'<col min="{i}" max="{i}" width="20" style="{STYLE_IDS[style]}"/>'
            for i, style in enumerate(self.styles, 1)
            if style
        )
        header = "".join(
            f'<c t="inlineStr"><is><t xml:space="preserve">{escape(name)}</t></is></c>'
            for name in self.columns
        )
        return (
            f'{XML}<worksheet xmlns="{MAIN}">'
            + (f"<cols>{columns}</cols>" if columns else "")
            + f"<sheetData><row>{header}</row>"
        )


class OdsWriter(WorkbookWriter):
    extension = ".ods"
    sheet_part = "content.xml"
    tail = "</table:table></office:spreadsheet></office:body></office:document-content>"

    def static_parts(self):
        entries = "".join(
            f'<manifest:file-entry manifest:full-path="{path}" manifest:media-type="{kind}"/>'
            for path, kind in (("/", ODS_TYPE), ("content.xml", "text/xml"))
        )
        manifest = (
            f'{XML}<manifest:manifest {ODS_NAMESPACES} manifest:version="1.2">'
            f"{entries}</manifest:manifest>"
        )
        # the format wants its type first and uncompressed
        return [
            ("mimetype", ODS_TYPE, zipfile.ZIP_STORED),
            ("META-INF/manifest.xml", manifest, zipfile.ZIP_DEFLATED),
        ]

    def head(self):
        header = "".join(
            '<table:table-cell office:value-type="string">'
            f"<text:p>{escape(name)}</text:p></table:table-cell>"
            for name in self.columns
        )
        return (
            f'{XML}<office:document-content {ODS_NAMESPACES} office:version="1.2">'
            '<office:body><office:spreadsheet><table:table table:name="Sheet 1">'
            f"<table:table-row>{header}</table:table-row>"
        )
