"""Worksheets of workbooks as relations: the XML members of the archive, parsed by Spark and joined.

A workbook is an archive of XML: its list of sheets, shared texts, styles, and one member a sheet. Each is parsed by
from_xml into arrays and exploded; cells find their shared texts and styles by joins. No workbook library is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annoforge.functions.workers import reachable
from annoforge.sources.readers import SourceError
from annoforge.sources.zips import Members, ZipSource

OPTIONS = {"ignoreNamespace": "true", "attributePrefix": "_", "ignoreSurroundingSpaces": "false"}
_TEXT = "struct<_VALUE:string,_space:string>"
SHEET = "sheetData struct<row:array<struct<_r:bigint,c:array<struct<_r:string,_t:string,_s:bigint,v:string,f:struct<_VALUE:string,_t:string,_ref:string,_si:string>,`is`:struct<t:" + _TEXT + ",r:array<struct<t:" + _TEXT + ">>>>>>>>"
STRINGS = "si array<struct<t:" + _TEXT + ",r:array<struct<t:" + _TEXT + ">>>>"
STYLES = "numFmts struct<numFmt:array<struct<_numFmtId:bigint,_formatCode:string>>>, cellXfs struct<xf:array<struct<_numFmtId:bigint>>>"
BOOK = "workbookPr struct<_date1904:string>, sheets struct<sheet:array<struct<_name:string,_sheetId:bigint,_id:string>>>"
LINKS = "Relationship array<struct<_Id:string,_Target:string,_Type:string>>"
#: Numbers of the built-in formats that show a date or a time.
DATE_FORMATS = [*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)]


class Workbooks(ZipSource):
    @classmethod
    def name(cls) -> str:
        return "annoforge_workbook"

    def reader(self, schema) -> Members:
        return Members(self.options | {"content": "true"}, ".xlsx")


def parts(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, xml) of workbooks at or below a path."""
    reachable(spark)
    spark.dataSource.register(Workbooks)
    rows = spark.read.format("annoforge_workbook").load(path)
    return rows.where(F.col("member").rlike(r"\.(xml|rels)$")).select("archive", "member", F.decode("content", "UTF-8").alias("xml"))


def parsed(members: DataFrame, pattern: str, schema: str) -> DataFrame:
    return members.where(F.col("member").rlike(pattern)).select("archive", "member", F.from_xml("xml", schema, OPTIONS).alias("x"))


def plain_text(item: Column) -> Column:
    """Text of an item that is one text or runs of texts."""
    runs = F.array_join(F.transform(item["r"], lambda r: F.coalesce(r["t"]["_VALUE"], F.lit(""))), "")
    return F.coalesce(item["t"]["_VALUE"], runs, F.lit(""))


def sheet_members(members: DataFrame) -> DataFrame:
    """(archive, sheet, member, early): the member of every sheet by name, and whether its days count from 1904."""
    book = parsed(members, r"^xl/workbook\.xml$", BOOK).select("archive", F.coalesce(F.col("x.workbookPr._date1904").isin("1", "true"), F.lit(False)).alias("early"), F.explode("x.sheets.sheet").alias("s"))
    links = parsed(members, r"^xl/_rels/workbook\.xml\.rels$", LINKS).select("archive", F.explode("x.Relationship").alias("l")).select("archive", F.col("l._Id").alias("id"), F.regexp_replace("l._Target", "^/?(xl/)?", "xl/").alias("member"))
    return book.select("archive", "early", F.col("s._name").alias("sheet"), F.col("s._id").alias("id")).join(links, ["archive", "id"]).drop("id")


def date_styles(members: DataFrame) -> DataFrame:
    """(archive, style): cell styles that show a date or a time."""
    styles = parsed(members, r"^xl/styles\.xml$", STYLES)
    own = styles.select("archive", F.explode("x.numFmts.numFmt").alias("n")).select("archive", F.col("n._numFmtId").alias("format"), F.regexp_replace("n._formatCode", r'"[^"]*"|\[[^\]]*\]|\\.', "").alias("code"))
    dates = own.where(F.col("code").rlike("(?i)[ymdhs]")).select("archive", "format")
    used = styles.select("archive", F.posexplode("x.cellXfs.xf").alias("style", "xf")).select("archive", F.col("style").cast("bigint").alias("style"), F.col("xf._numFmtId").alias("format"))
    listed = used.where(F.col("format").isin(*DATE_FORMATS)).select("archive", "style")
    return listed.unionByName(used.join(dates, ["archive", "format"], "left_semi").select("archive", "style")).distinct()


def column_number(reference: Column) -> Column:
    """1 for A, 27 for AA."""
    letters = F.split(F.regexp_extract(reference, "^([A-Z]+)", 1), "")
    return F.aggregate(F.filter(letters, lambda x: x != ""), F.lit(0), lambda a, x: a * 26 + F.ascii(x) - 64)


def moment(serial: Column, early: Column) -> Column:
    """A day number as text, to the second. Serials up to 59 lie before the day that never was."""
    day = F.when(early, serial + 1462).when(serial < 60, serial + 1).otherwise(serial)
    at = F.timestamp_seconds(F.round((day - 25569) * 86400))
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss")


def cells(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """(archive, row, column, value) of the filled cells of a sheet: texts, numbers as written, True and False, dates
    as text, formulas as `=...`. A workbook without the sheet fails."""
    members = parts(spark, path)
    found = sheet_members(members)
    books = members.select("archive").distinct()
    lost = books.join(found.where(F.col("sheet") == sheet), "archive", "left_anti").limit(1).collect()
    if lost:
        raise SourceError(f"{lost[0]['archive']} has no sheet {sheet}")
    chosen = found.where(F.col("sheet") == sheet).select("archive", "member", "early")
    rows = parsed(members, r"^xl/worksheets/[^/]+\.xml$", SHEET).join(F.broadcast(chosen), ["archive", "member"])
    rows = rows.select("archive", "early", F.posexplode("x.sheetData.row").alias("at", "r")).select("archive", "early", F.coalesce("r._r", F.col("at") + 1).alias("row"), F.posexplode("r.c").alias("place", "c"))
    numbered = F.when(F.col("c._r").isNotNull(), column_number(F.col("c._r"))).otherwise(F.col("place") + 1)
    flat = rows.select("archive", "early", "row", numbered.alias("column"), F.col("c._t").alias("kind"), F.col("c._s").alias("style"), F.col("c.v").alias("v"), F.col("c.f._VALUE").alias("formula"), F.when(F.col("c.is").isNotNull(), plain_text(F.col("c.is"))).alias("inline"))
    texts = parsed(members, r"^xl/sharedStrings\.xml$", STRINGS).select("archive", F.posexplode("x.si").alias("number", "item")).select("archive", F.col("number").cast("bigint").alias("number"), plain_text(F.col("item")).alias("text"))
    with_text = flat.withColumn("number", F.when(F.col("kind") == "s", F.try_to_number("v", F.lit("999999999999")).cast("bigint"))).join(texts, ["archive", "number"], "left")
    dated = with_text.join(F.broadcast(date_styles(members).withColumn("is_date", F.lit(True))), ["archive", "style"], "left")
    number = F.when(F.col("v").rlike(r"^-?\d+$"), F.col("v")).otherwise(F.col("v").try_cast("double").cast("string"))
    value = (
        F.when(F.col("formula").isNotNull(), F.concat(F.lit("="), F.ltrim(F.col("formula"), F.lit("="))))
        .when(F.col("kind") == "s", F.col("text"))
        .when(F.col("kind") == "inlineStr", F.col("inline"))
        .when(F.col("kind") == "b", F.when(F.col("v") == "1", "True").otherwise("False"))
        .when(F.col("kind").isin("str", "e", "d"), F.col("v"))
        .when(F.col("is_date"), moment(F.col("v").try_cast("double"), F.col("early")))
        .otherwise(number)
    )
    return dated.select("archive", "row", F.col("column").cast("int").alias("column"), value.alias("value")).where(F.col("value").isNotNull())


def records(spark: SparkSession, path: str, sheet: str, columns: list[str] | None = None) -> DataFrame:
    """Rows below the header as texts, blanks where a cell is empty, with the archive and row they stand in; rows
    without any value are left out. columns: those that the header must have, in any order; else the first workbook's."""
    held = cells(spark, path, sheet)
    first = held.groupBy("archive").agg(F.min("row").alias("top"))
    header = held.join(first, "archive").where("row = top").select("archive", "column", F.trim("value").alias("name")).where("name <> ''")
    once = header.withColumn("n", F.row_number().over(Window.partitionBy("archive", "name").orderBy(F.desc("column")))).where("n = 1").drop("n")
    if columns is None:
        some = once.agg(F.min_by("archive", "archive")).first()[0]
        columns = [r["name"] for r in once.where(F.col("archive") == some).orderBy("column").collect()]
    wanted = set(columns)
    have = once.where(F.col("name").isin(*columns)).groupBy("archive").agg(F.collect_set("name").alias("names"))
    lost = first.join(have, "archive", "left").where(F.size(F.coalesce("names", F.array().cast("array<string>"))) < len(wanted)).limit(1).collect()
    if lost:
        raise SourceError("missing columns: " + ", ".join(sorted(wanted - set(lost[0]["names"] or []))))
    named = held.join(once, ["archive", "column"]).join(first, "archive").where("row > top")
    cellular = named.groupBy("archive", "row").agg(*[F.max(F.when(F.col("name") == c, F.col("value"))).alias(c) for c in columns])
    return cellular.select("archive", "row", *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns])
