"""Wide matrices whose rows and columns carry several labels each.

A matrix may have tens of thousands of columns, so it is never read as
columns. A line stays one array of text cells until everything that depends
on the row label or on the column label alone has been done: recodes, filters
and joins run once per line and once per column, not once per cell.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftable import classification as c
from weftable.functions.labels import finite_or_null, lenient_double
from weftable.sources.staging import stage

_POSITION = "_pos"
_FIELDS = "_fields"

#: What a row of ``cells_and_sums`` is.
CELL, LINE_SUM, LINE_SIZE = range(3)

# Lines looked at for label lines beyond those that are named.
_MOST_LABEL_LINES = 16


@dataclass(frozen=True)
class LabelledMatrix:
    """A matrix as lines (row labels + cells) and a column dimension."""

    rows: DataFrame
    columns: DataFrame
    width: int

    def with_rows(self, change: Callable[[DataFrame], DataFrame]) -> "LabelledMatrix":
        """Derive, filter or join on row labels; runs once per line."""
        return replace(self, rows=change(self.rows))

    def with_columns(self, change: Callable[[DataFrame], DataFrame]) -> "LabelledMatrix":
        """Derive, filter or join on column labels; runs once per column."""
        return replace(self, columns=change(self.columns))

    def cells(self) -> DataFrame:
        """One row per cell: row labels, column labels and a double ``value``.

        Text that is no number, or says that it is none (NaN), gives a null value.
        The column dimension is staged, so its join with the cells is planned
        by the bytes it has.
        """
        columns = stage(self.columns, "columns")
        labels = [name for name in self.rows.columns if name != _FIELDS]
        exploded = self.rows.select(*labels, F.posexplode(_FIELDS).alias(_POSITION, "_cell"))
        others = [name for name in columns.columns if name != _POSITION]
        return exploded.join(columns, _POSITION).select(*labels, *others, _number("_cell").alias("value"))

    def cells_and_sums(self) -> DataFrame:
        """The rows of ``cells``, and of each line the sum of its cells and the sum of their sizes.

        ``_entry`` tells them apart (CELL, LINE_SUM, LINE_SIZE); sums have no
        column labels. A line is summed where it lies, in the same unfolding; a
        missing cell makes both of its sums null.
        """
        labels = [name for name in self.rows.columns if name != _FIELDS]
        others = [name for name in self.columns.columns if name != _POSITION]
        sums = F.explode(
            F.array(*[F.struct(F.lit(self.width + i).alias("at"), F.lit(e).alias("entry")) for i, e in enumerate((LINE_SUM, LINE_SIZE))])
        )
        extra = self.rows.sparkSession.range(1).select(sums.alias("e")).select(F.col("e.at").alias(_POSITION), F.col("e.entry").alias("_entry"))
        columns = stage(self.columns.withColumn("_entry", F.lit(CELL)).unionByName(extra, allowMissingColumns=True), "columns")
        numbers = self.rows.select(*labels, F.transform(_FIELDS, _number).alias("_numbers"))
        zero = F.lit(0.0)
        total = F.aggregate("_numbers", zero, lambda sum_, x: sum_ + x)
        size = F.aggregate("_numbers", zero, lambda sum_, x: sum_ + F.abs(x))
        unfolded = numbers.select(
            *labels, F.posexplode(F.concat("_numbers", F.array(total, size))).alias(_POSITION, "value")
        )
        return unfolded.join(columns, _POSITION).select(*labels, *others, "_entry", "value")

    def line_totals(self) -> DataFrame:
        """One row per line: row labels, the sum of its cells and the sum of their sizes.

        A line is summed where it lies, without unfolding it; a missing cell
        makes both sums null.
        """
        labels = [name for name in self.rows.columns if name != _FIELDS]
        zero = F.lit(0.0)
        total = F.aggregate(_FIELDS, zero, lambda sum_, cell: sum_ + _number(cell))
        size = F.aggregate(_FIELDS, zero, lambda sum_, cell: sum_ + F.abs(_number(cell)))
        return self.rows.select(*labels, total.alias("value"), size.alias("scale"))


def _number(cell: Column | str) -> Column:
    return finite_or_null(lenient_double(cell))


def _field_pattern(sep: str, quote: str) -> str:
    """A separator and the field after it; a quoted field may hold separators, and quotes if they are doubled."""
    q, x = re.escape(quote), re.escape(sep)
    return f"{x}((?:{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q})?+[^{x}]*+)"


def _fields_of(line: str, sep: str, quote: str) -> list[str]:
    return re.findall(_field_pattern(sep, quote), sep + line) if quote and quote in line else line.split(sep)


def _split(line: Column, sep: str, quote: str, size: int) -> Column:
    """The fields of a line. Quotes are looked at only where a plain split gives more fields than there should be."""
    plain = F.split(line, re.escape(sep), -1)
    if not quote:
        return plain
    aware = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(_field_pattern(sep, quote)), F.lit(1))
    return F.when((F.size(plain) > size) & line.contains(quote), aware).otherwise(plain)


def _unquoted(text: str, quote: str) -> str:
    text = text.strip()
    if quote and len(text) >= 2 and text[0] == quote and text[-1] == quote:
        text = text[1:-1].replace(quote * 2, quote)
    return text


def _without_quotes(text: Column, quote: str) -> Column:
    text = F.trim(text)
    if not quote:
        return text
    inner = F.replace(F.substring(text, F.lit(2), F.length(text) - 2), F.lit(quote * 2), F.lit(quote))
    return F.when((F.length(text) >= 2) & text.startswith(quote) & text.endswith(quote), inner).otherwise(text)


def _is_number(text: str) -> bool:
    try:
        float(text)
    except ValueError:
        return False
    return True


@dataclass(frozen=True)
class _Head:
    """The first lines of a matrix, as the driver has them."""

    fields: list[list[str]]
    digests: list[int]
    named: int
    n_cols: int
    names: frozenset[str]

    def verdict(self, i: int) -> str:
        """What line ``i`` is: data, labels, or unknown.

        A number among its cells makes it data. Leading fields that are empty, or names of
        labels, make it a label line. A leading field that is a column's label makes it data, for the
        rows and columns of a matrix share their codes.
        """
        line = self.fields[i]
        if any(_is_number(cell) for cell in line[self.n_cols :]):
            return "data"
        leading = [x for x in line[: self.n_cols] if x]
        if all(x.lower() in self.names for x in leading):
            return "labels"
        columns = {x for fields in self.fields[: self.named] for x in fields[self.n_cols :]}
        return "data" if any(x in columns for x in leading) else "unknown"


def _label_lines(head: _Head, repeated: Callable[[int], bool | None], path: str) -> int:
    """How many leading lines hold labels.

    A line that its own fields do not tell is a label line if other parts of the
    matrix repeat it, and data if there are other parts that do not.
    """
    for i in range(head.named, len(head.fields)):
        verdict = head.verdict(i)
        if verdict == "unknown":
            again = repeated(head.digests[i])
            if again is None:
                raise ValueError(f"{path}: line {i + 1} has no number and may be labels or data, give label_lines")
            verdict = "labels" if again else "data"
        if verdict == "data":
            return i
    return len(head.fields)


def read_matrix(
    spark: SparkSession,
    path: str,
    row_labels: Sequence[str],
    column_labels: Sequence[str],
    sep: str = "\t",
    quote: str = "",
    encoding: str = "UTF-8",
    label_lines: int | None = None,
    names: Sequence[str] = c.MATRIX_LABEL_NAMES,
) -> LabelledMatrix:
    """Read a delimited text matrix, or a folder of parts of one matrix.

    ``row_labels`` names the leading label fields of every line and
    ``column_labels`` the leading label lines. Further label lines are
    recognised by what they are: their leading fields are empty or among ``names``
    (and ``row_labels``), or every part repeats them. A line of data needs no
    number if one of its labels is a column's too. What cannot be told is an
    error, unless ``label_lines`` counts the label lines; that is an error if the
    next line holds labels. Every part starts with the same label lines. A line that is
    longer or shorter than the label lines is an error. Only the label lines of
    one part come to the driver; their length is the width of the matrix.

    With ``quote``, a field in quotes may hold separators and doubled quotes.
    """
    named, n_cols = len(column_labels), len(row_labels)
    raw = spark.read.text(path).select(
        "value", F.col("_metadata.file_block_start").alias("_start"), F.col("_metadata.file_path").alias("_file")
    )
    text = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    lines = raw.select(F.rtrim(text, F.lit("\r")).alias("value"), "_start", "_file").where(F.length("value") > 0)
    most = _MOST_LABEL_LINES if label_lines is None else label_lines + 1
    digest = F.xxhash64("value")
    first_lines = lines.where("_start = 0").select("value", digest.alias("digest"), "_file").head(max(most, named) + 1)
    first_lines = [row for row in first_lines if row["_file"] == first_lines[0]["_file"]]
    header = [[_unquoted(x, quote) for x in _fields_of(row["value"], sep, quote)] for row in first_lines]
    if len(header) < named:
        raise ValueError(f"{path} has fewer than {named} label lines")
    known = frozenset(x.lower() for x in (*names, *row_labels, *column_labels))
    head = _Head(header, [row["digest"] for row in first_lines], named, n_cols, known)

    def repeated(line: int) -> bool | None:
        """Whether another file starts with the line too; None if there is no other file."""
        starts = lines.where("_start = 0")
        files = starts.agg(F.countDistinct("_file"), F.countDistinct(F.when(digest == line, F.col("_file")))).first()
        return None if files[0] < 2 else files[1] > 1

    count = _label_lines(head, repeated, path) if label_lines is None else label_lines
    if count < named or len(header) < count:
        raise ValueError(f"{path} has fewer than {max(named, count)} label lines")
    if label_lines is not None and len(header) > count and head.verdict(count) == "labels":
        raise ValueError(f"{path} has more than {count} label lines")
    width = len(header[0]) - n_cols
    if any(len(fields) != len(header[0]) for fields in header[:named]):
        raise ValueError(f"the label lines of {path} differ in size")

    labels = {name: fields[n_cols:] for name, fields in zip(column_labels, header)}
    columns = spark.createDataFrame(
        pa.table({_POSITION: pa.array(range(width), pa.int32()), **labels})
    )

    # A label line is recognised by its own label fields, in the first block of
    # a file only; if the rest of it differs from the label lines read above,
    # the parts do not belong together. Only the start of a line is looked at,
    # and the plan holds those starts and digests, not the lines.
    def mark(text):
        return F.translate(F.substring_index(text, sep, n_cols), f" {quote}", "")

    starts = dict.fromkeys(sep.join(row["value"].split(sep)[:n_cols]) for row in first_lines[:count])
    is_label = (F.col("_start") == 0) & mark(F.col("value")).isin(*[mark(F.lit(start)) for start in starts])
    foreign = is_label & ~digest.isin(*dict.fromkeys(head.digests[:count]))
    is_data = F.when(
        foreign, F.raise_error(F.lit(f"label lines differ between parts of {path}")).cast("boolean")
    ).otherwise(~is_label)
    cells = F.when(
        F.size("_all") == width + n_cols, F.slice("_all", F.lit(n_cols + 1), F.lit(max(width, 0)))
    ).otherwise(
        F.raise_error(F.concat(F.lit(f"a line of {path} has another size than its label lines: "), F.size("_all")))
    )
    if quote:  # numbers in quotes, where there are any
        cells = F.when(F.col("_quoted"), F.transform(cells, lambda x: _without_quotes(x, quote))).otherwise(cells)
    labels_end = F.length(F.substring_index("value", sep, n_cols)) + 1
    inner = F.call_function("locate", F.lit(quote), F.col("value"), labels_end) > 0 if quote else F.lit(False)

    rows = (
        lines.withColumn("_all", _split(F.col("value"), sep, quote, width + n_cols))
        .withColumn("_quoted", inner)
        .where(is_data)
        .select(
            *[_without_quotes(F.get(F.col("_all"), F.lit(i)), quote).alias(name) for i, name in enumerate(row_labels)],
            cells.alias(_FIELDS),
        )
    )
    return LabelledMatrix(rows, columns, width)
