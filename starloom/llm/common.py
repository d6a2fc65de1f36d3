"""What the operators share: row ids, stored intermediate tables, and words of whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import delete_path, materialise, shuffles_dropped

CHUNK_BYTES = 1 << 20  # numpy works on this much text at a time, or on one longer document


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _position(df: DataFrame) -> tuple[F.Column, F.Column, F.Column] | None:
    """(path, name, row index) of each row's file; none where the rows do not come straight from Parquet files."""
    try:
        file = df.metadataColumn("_metadata")
        place = file.getField("file_path"), file.getField("file_name"), file.getField("row_index")
        _ = df.select(*place).schema
        return place
    except AnalysisException:
        return None


def as_table(df: DataFrame) -> DataFrame:
    """``df`` itself where it reads Parquet files, with columns and rows left out or not; else a stored copy."""
    return df if _position(df) else stored(df, "rows")


def with_row(df: DataFrame, name: str = "_row") -> DataFrame:
    """Adds a unique number per row, so that null and repeated ids stay apart.

    The number is made of the row's file and its place there, so every evaluation gives a row the
    same one, however Spark splits the files and however many cores it has. Low bits are the place,
    high bits a hash of the file's name, or of its path where names repeat; that no two files share
    the high bits is checked, and another seed taken otherwise. A frame that does not read Parquet
    files is stored first; to number one twice alike, take ``as_table`` of it before.
    """
    df = as_table(df)
    path, file, index = _position(df)
    files = df.groupBy(path.alias("path"), file.alias("name")).agg(F.max(index).alias("top"), F.count("*").alias("n"))
    files = materialise(files, "row-files")
    seen = files.agg(F.count("*").alias("files"), F.countDistinct("name").alias("names"), F.max("top").alias("top"),
                     F.max(F.col("n") - F.col("top")).alias("twice")).first()
    if (seen["twice"] or 0) > 1:
        raise ValueError("the frame repeats rows of its files; store it first")
    bits = (seen["top"] or 0).bit_length()
    by_name = seen["names"] == seen["files"]

    def high(key: F.Column, seed: int) -> F.Column:
        return F.shiftleft(F.xxhash64(F.lit(seed), key), bits).bitwiseAND(F.lit((1 << 63) - 1))

    seed, key = 0, "name" if by_name else "path"
    while files.agg(F.countDistinct(high(F.col(key), seed)).alias("n")).first()["n"] < seen["files"]:
        seed += 1
    return df.withColumn(name, high(file if by_name else path, seed).bitwiseOR(index))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes to the shared folder and reads back; the shuffle files behind it go at once."""
    with shuffles_dropped(df.sparkSession):
        return materialise(df, label)


def discard(table: DataFrame) -> None:
    """Deletes a table of ``stored`` that nothing reads any more."""
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        delete_path(table.sparkSession, folder)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, UTF-8 bytes of each text) of consecutive rows with about ``limit`` bytes together; null is empty."""
    data, first, size = [], 0, 0
    for i, scalar in enumerate(column.cast(pa.large_binary())):
        text = scalar.as_py() or b""
        if data and size + len(text) > limit:
            yield first, data
            data, first, size = [], i, 0
        data.append(text)
        size += len(text) + 1
    if data:
        yield first, data


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of the same chunks as ``text_chunks``.

    Each text is followed by one line feed, which belongs to no text: offsets[i] to
    offsets[i + 1] - 1 is text i.
    """
    for first, texts in text_chunks(column, limit):
        yield first, *_joined(texts)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    return np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), offsets


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_codes(seed: int) -> np.ndarray:
    """A random 64-bit code for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


BASE = np.uint64(0x5851F42D4C957F2D)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the base and of its inverse, grown when a longer text comes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 4096)
            self.up, self.down = powers(BASE, size), powers(BASE_INVERSE, size)
        return self.up, self.down


def prefix_hashes(data: np.ndarray, codes: np.ndarray, up: np.ndarray) -> np.ndarray:
    """P with P[i] = sum of codes[data[j]] * BASE ** j over j < i, modulo 2 ** 64."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(codes[data] * up[: len(data)], out=out[1:])
    return out


SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``; data ends in white space."""
    space = SPACES[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray, pw: Powers) -> np.ndarray:
    """A 64-bit hash of each word's bytes and length."""
    up, down = pw.to(len(data) + 1)
    prefix = prefix_hashes(data, codes, up)
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def seeded_unit(seed: int, *columns) -> F.Column:
    """A number in [0, 1) from a hash of the columns; the same in SQL as 13 hex digits of md5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    digits = F.substring(F.md5(text.cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))
