"""Helpers shared by the text operators: row identity, free column names, whole-text batches, two-generation caches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Hashable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts handed to numpy code at once; a single longer text is handed over alone and whole.
BLOCK_BYTES = 4 << 20


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    """A column by its literal name, also with dots or backticks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """The text column; null counts as the empty text."""
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty); further columns, whatever their names, are left behind."""
    return df.select(quoted(doc_id).alias("doc_id"), text_of(text).alias("text"))


def row_version(text: Column) -> Column:
    """Tells rows with the same id and different texts apart. Rows equal in id and text are one document."""
    return F.xxhash64(text)


def same_row(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> Column:
    """Join condition that also matches null ids."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of ``texts`` of at most ``limit`` bytes, or of one text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def row_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """The same for an Arrow column; values that are no text or bytes go in ranges of 512."""
    if pa.types.is_string(texts.type) or pa.types.is_binary(texts.type):
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    else:
        size = np.arange(1, len(texts) + 1) * (limit // 512)
    start = before = 0
    while start < len(size):
        end = max(start + 1, int(np.searchsorted(size, before + limit, "right")))
        yield start, end
        start, before = end, int(size[end - 1])


def map_texts(df: DataFrame, function: Callable[[list], dict[str, list]], schema: str, keep: tuple[str, ...], text: str = "text", holds: bool = False) -> DataFrame:
    """Columns ``keep`` of ``df`` plus the columns that ``function(texts)`` returns, one value per text.

    Rows stay in their partition and are handled an Arrow batch at a time. ``holds`` says that the function uses :func:`per_worker`.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = df.select(*keep).schema
    for field in df.sparkSession.createDataFrame([], schema).schema:
        out_schema = out_schema.add(field)
    arrow = to_arrow_schema(out_schema)

    def run(batches):
        if not holds:
            release()
        for batch in batches:
            for i, j in row_blocks(batch.column(batch.schema.get_field_index(text))):
                part = batch.slice(i, j - i)
                made = function(part.column(part.schema.get_field_index(text)).to_pylist())
                columns = [part.column(part.schema.get_field_index(k)).cast(arrow.field(k).type) for k in keep]
                columns += [pa.array(made[f.name], type=f.type) for f in list(arrow)[len(keep):]]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.select(*dict.fromkeys((*keep, text))).mapInArrow(run, out_schema)


class Remembered(dict):
    """``memory[key]`` computes a value once and keeps the most used ones: when ``size`` values are young, they become
    the old generation and the values that were not used since are forgotten. At most 2 x ``size`` values are held.
    """

    def __init__(self, compute: Callable, size: int, start: dict | None = None):
        super().__init__(start or {})
        self.compute, self.size, self.start, self.old = compute, size + len(start or {}), start, {}

    def __missing__(self, key: Hashable):
        value = self.old.pop(key, None)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
            if self.start:
                self.update(self.start)
        self[key] = value
        return value


_HELD: dict[str, object] = {}
try:
    _LIBC = ctypes.CDLL("libc.so.6")  # glibc keeps freed memory unless told
except OSError:
    _LIBC = None
#: Rows of texts that Spark hands to Python at once (its default is 10,000, of whatever length).
BATCH_ROWS = 2000


def per_worker(name: str, make: Callable[[], object]) -> object:
    """What ``make`` returns, kept by this worker process for its next tasks; one object at a time, named by its content."""
    if name not in _HELD:
        release()
        _HELD[name] = make()
    return _HELD[name]


def release() -> None:
    """Forget what :func:`per_worker` holds and give freed memory back to the system, so that the next operator finds it free."""
    if _HELD:
        _HELD.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


_SHIPPED: set[str] = set()


def ship(spark) -> None:
    """Send this package to the executors once per application, so that Python tasks can import it wherever they run, and let the
    session hand over at most :data:`BATCH_ROWS` rows at once."""
    context = spark.sparkContext
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="carelens-")) / "carelens_package.zip"  # read by the driver only
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*")):
            if path.suffix in {".py", ".npz"}:
                out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
