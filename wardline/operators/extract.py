"""Message -> typed rows (E1-E4), one parse per message for all four tables.

``parse_hl7`` / ``parse_xml`` add one parsed column; the four extractors only
read that column, so fanning a parsed batch out to four tables never parses a
message twice. All of it is narrow (no shuffle) and stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from wardline.functions import hl7, xmlmsg
from wardline.schemas import ADT_HIST, DX_HIST, ER_HIST, VISIT_HIST, data_columns

PARSED = "_msg"
HL7, XML = "hl7", "xml"


def parse_hl7(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the parsed message; the segment split is its own projection so it runs once."""
    return df.withColumn("_lines", hl7.lines(F.col(text))) \
        .withColumn(PARSED, hl7.parse_lines(F.col("_lines"))).drop("_lines")


def parse_xml(df: DataFrame, text: str = "text", segments: dict | None = None) -> DataFrame:
    """Adds the parsed envelope, normalized to one struct of segments (four projections). ``segments``, as
    ``xmlmsg.DX_ONLY``, for one table alone; all that the four tables read otherwise."""
    return df.withColumn("_env", xmlmsg.parse(F.col(text), segments)) \
        .withColumn("_tags", xmlmsg.locate(F.col("_env"), F.col(text))) \
        .withColumn("_root", xmlmsg.root_of(F.col("_tags"))) \
        .withColumn(PARSED, xmlmsg.normalize(F.col("_env"), F.col("_tags"), F.col("_root"), segments)).drop("_env", "_tags", "_root")


def parse(df: DataFrame, fmt: str, text: str = "text", segments: dict | None = None) -> DataFrame:
    return parse_hl7(df, text) if fmt == HL7 else parse_xml(df, text, segments)


def ordered_columns(cols: dict[str, Column], schema, extra: dict[str, Column]) -> list[Column]:
    out = []
    for name in data_columns(schema):
        c = cols.get(name, extra.get(name))
        out.append((c if c is not None else F.lit(None).cast(schema[name].dataType)).cast(schema[name].dataType).alias(name))
    return out


def adt_detail(parsed: DataFrame, fmt: str = HL7, msg_src: str = hl7.HL7_SOURCE, columns: tuple[str, ...] | None = None) -> DataFrame:
    """One ADT row per message, in table column order (audit stamps left to the sink).
    Of its ``columns`` only some, if they are given: the projections below keep Spark from leaving out the others.

    A projection for each step (raw text, its marks, times, the rest): each field is cut once,
    and each generated method stays small enough for whole-stage code generation and for the
    JVM to compile.
    """
    nm = F.col("msg_nm") if "msg_nm" in parsed.columns else F.lit(None).cast("string")
    staged, cols = _staged_adt(parsed, fmt, msg_src, {"msg_nm": nm}, columns)
    row = dict(zip(data_columns(ADT_HIST), ordered_columns(cols, ADT_HIST, {}), strict=True))
    return staged.select(*[c for k, c in row.items() if columns is None or k in columns])


def _staged_adt(parsed: DataFrame, fmt: str, msg_src: str, kept: dict[str, Column],
                columns: tuple[str, ...] | None = None) -> tuple[DataFrame, dict[str, Column]]:
    """All that the ADT row and the columns ``kept`` are made of, and both as columns of that.

    Every projection hands on structs only, which the next one reads more than once: Spark then
    gives it a method of its own, instead of one for all of them that the JVM would only interpret."""
    m = F.col(PARSED)
    held = F.struct(*[c.alias(k) for k, c in kept.items()]).alias("_kept")
    if fmt == HL7:  # fields of several components are split in a projection of their own, once
        parsed = parsed.withColumn("_parts", F.struct(*[c.alias(k) for k, c in hl7.adt_parts(m).items()]))
        raw, conv, c = hl7.adt_cut(m, msg_src, F.col("_parts")), hl7.convert, F.col("_cut")
        raw = {k: x for k, x in raw.items() if columns is None or k in columns}
        cut = parsed.select(F.struct(*[x.alias(k) for k, x in raw.items()], held).alias("_cut"))
        staged = cut.select(F.struct(*[hl7.literal_held(c[k]).alias(k) for k in raw], c["_kept"].alias("_kept")).alias("_raw"))
    else:
        raw, conv = {k: x for k, x in xmlmsg.adt_raw(m).items() if columns is None or k in columns}, xmlmsg.convert
        staged = parsed.select(F.struct(*[x.alias(k) for k, x in raw.items()], held).alias("_raw"))
    staged, cols = typed(staged, list(raw), conv)
    return staged, cols | {k: F.col("_raw")["_kept"][k] for k in kept}


def typed(staged: DataFrame, names: list[str], conv) -> tuple[DataFrame, dict[str, Column]]:
    """The fields ``names`` of ``_raw`` converted; the times, which are long expressions, by a projection of their own."""
    r = F.col("_raw")
    times = [k for k in names if k in ADT_HIST.fieldNames() and isinstance(ADT_HIST[k].dataType, TimestampType)]
    if not times:
        return staged, {k: conv(k, r[k]) for k in names}
    staged = staged.select("_raw", F.struct(*[conv(k, r[k]).alias(k) for k in times]).alias("_times"))
    return staged, {k: F.col("_times")[k] if k in times else conv(k, r[k]) for k in names}


def _header(fmt: str, msg_src: str):
    """Header columns and the condition that all three are present."""
    m = F.col(PARSED)
    src, tm, csn = hl7.child_header(m, msg_src) if fmt == HL7 else xmlmsg.child_header(m)
    ok = tm.isNotNull() & csn.isNotNull() & src.isNotNull()
    return src.alias("msg_src"), tm.alias("msg_tm"), csn.alias("pat_enc_csn_id"), ok


# The children keep or drop rows inside the generator (an incomplete header
# yields a NULL array, hence no rows) rather than with a filter: a filter
# would be pushed below the parse and re-evaluate the header from raw text.


def encounter_dx(parsed: DataFrame, fmt: str = HL7, msg_src: str = hl7.HL7_SOURCE) -> DataFrame:
    """0..n diagnosis rows per message."""
    src, tm, csn, ok = _header(fmt, msg_src)
    rows = hl7.dx_rows(F.col(PARSED)) if fmt == HL7 else xmlmsg.dx_rows(F.col(PARSED))
    return parsed.select(src, tm, csn, ok.alias("_ok"), rows.alias("_rows")) \
        .select("msg_src", "msg_tm", "pat_enc_csn_id", F.inline(F.when(F.col("_ok"), F.col("_rows"))))


def er_complaint(parsed: DataFrame, fmt: str = HL7, msg_src: str = hl7.HL7_SOURCE) -> DataFrame:
    """0..1 ER complaint row per message."""
    src, tm, csn, ok = _header(fmt, msg_src)
    c = hl7.er_complaint(F.col(PARSED)) if fmt == HL7 else xmlmsg.er_complaint(F.col(PARSED))
    staged = parsed.select(src, tm, csn, ok.alias("_ok"), c.alias("_c"))
    return staged.select("msg_src", "msg_tm", "pat_enc_csn_id",
                         F.explode(F.when(F.col("_ok") & F.col("_c").isNotNull(), F.array("_c"))).alias("er_complaint"))


def visit_reason(parsed: DataFrame, fmt: str = HL7, msg_src: str = hl7.HL7_SOURCE) -> DataFrame:
    """0..n visit reason rows per message."""
    src, tm, csn, ok = _header(fmt, msg_src)
    reasons = hl7.visit_reasons(F.col(PARSED)) if fmt == HL7 else xmlmsg.visit_reasons(F.col(PARSED))
    return parsed.select(src, tm, csn, ok.alias("_ok"), reasons.alias("_r")) \
        .select("msg_src", "msg_tm", "pat_enc_csn_id", F.explode(F.when(F.col("_ok"), F.col("_r"))).alias("encntr_rsn"))


def fan_out(parsed: DataFrame, fmt: str = HL7, msg_src: str = hl7.HL7_SOURCE) -> dict[str, DataFrame]:
    """The four history shapes from one parsed frame."""
    return {
        "adt_hist": adt_detail(parsed, fmt, msg_src),
        "encntr_dx_hist": encounter_dx(parsed, fmt, msg_src),
        "encntr_er_complnt_hist": er_complaint(parsed, fmt, msg_src),
        "encntr_visit_rsn_hist": visit_reason(parsed, fmt, msg_src),
    }


#: Prefix of an ADT column beside the other tables' rows.
ADT = "_adt_"
#: Prefix, until then, of the columns that stay as they are.
KEPT = "_kept_"


def cut_once(parsed: DataFrame, fmt: str = HL7, msg_src: str = hl7.HL7_SOURCE) -> DataFrame:
    """All that the four tables take from a message as plain columns instead of the parse: the ADT row's
    (under ``ADT``), and the children's rows. A cache of these is small and read by column; a cache
    of the parse would be decoded whole for every table."""
    m = F.col(PARSED)
    kept = [c for c in parsed.columns if c != PARSED]
    of = hl7 if fmt == HL7 else xmlmsg
    rows = {"_dx": of.dx_rows(m), "_er": of.er_complaint(m), "_visit": of.visit_reasons(m)}
    staged, cols = _staged_adt(parsed, fmt, msg_src, {KEPT + k: F.col(k) for k in kept} | rows)
    row = ordered_columns(cols, ADT_HIST, {"msg_nm": cols.get(KEPT + "msg_nm")})
    return staged.select(*[cols[KEPT + k].alias(k) for k in kept], *[c.alias(ADT + k) for k, c in zip(data_columns(ADT_HIST), row, strict=True)],
                         *[cols[k].alias(k) for k in rows])


def fan_out_cut(cut: DataFrame) -> dict[str, DataFrame]:
    """The four history shapes from :func:`cut_once`'s columns, the same rows as :func:`fan_out`'s."""
    header = [F.col(ADT + k).alias(k) for k in ("msg_src", "msg_tm", "pat_enc_csn_id")]
    ok = F.col(f"{ADT}msg_src").isNotNull() & F.col(f"{ADT}msg_tm").isNotNull() & F.col(f"{ADT}pat_enc_csn_id").isNotNull()
    return {
        "adt_hist": cut.select(*[F.col(ADT + k).alias(k) for k in data_columns(ADT_HIST)]),
        "encntr_dx_hist": cut.select(*header, F.inline(F.when(ok, F.col("_dx")))),
        "encntr_er_complnt_hist": cut.where(ok & F.col("_er").isNotNull()).select(*header, F.col("_er").alias("er_complaint")),
        "encntr_visit_rsn_hist": cut.select(*header, F.explode(F.when(ok, F.col("_visit"))).alias("encntr_rsn")),
    }


def with_validity(df: DataFrame, fmt: str, text: str = "text") -> DataFrame:
    """Adds ``reject_reason`` (NULL for accepted messages); XML needs the parsed column."""
    if fmt == HL7:
        return df.withColumn("reject_reason", hl7.validity(F.col(text)))
    return df.withColumn("reject_reason", xmlmsg.validity(F.col(PARSED)))


def split_valid(df: DataFrame, fmt: str = HL7, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) — rejects keep their text and reason instead of vanishing.

    HL7 is checked on the text, so the filter goes down to the scan. XML needs the
    parse; there the accepted rows come out of a generator (an invalid message gives
    an empty array) so the optimizer cannot copy the parse into a pushed-down filter.
    """
    v = with_validity(df, fmt, text)
    reason = F.col("reject_reason")
    if fmt == HL7:
        good = v.where(reason.isNull()).drop("reject_reason")
    else:
        others = [c for c in df.columns if c != PARSED]
        good = v.select(*others, F.explode(F.when(reason.isNull(), F.array(F.col(PARSED)))).alias(PARSED))
    bad = v.where(reason.isNotNull())
    if PARSED in bad.columns:
        bad = bad.drop(PARSED)
    return good, bad


def explode_batches(df: DataFrame, text: str = "text", spread: bool = True) -> DataFrame:
    """One row per envelope of a batched file, with its position ``part_no``. A file without
    readable text stays one row without text, to be rejected by name.

    The rows of a file are spread again, since a file is one row and parsing is the work. Files that fill the
    cluster's cores several times over need no such shuffle of all text (``spread`` False).
    """
    others = [c for c in df.columns if c != text]
    unread = F.array(F.lit(None).cast("string"))
    parts = F.when(F.col(text).isNull(), unread).otherwise(xmlmsg.split_batch(F.col(text)))
    rows = df.select(*others, F.posexplode(parts).alias("part_no", text))
    return rows.hint("rebalance") if spread else rows
