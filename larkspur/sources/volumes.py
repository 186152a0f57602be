"""Volumes: zip members, MetaImage and NIfTI headers, NPZ arrays. Decoded voxels stay in one binary per row."""

from __future__ import annotations

import gzip
import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MET = {"MET_SHORT": "<i2", "MET_USHORT": "<u2", "MET_UCHAR": "<u1", "MET_CHAR": "<i1", "MET_INT": "<i4", "MET_UINT": "<u4", "MET_FLOAT": "<f4", "MET_DOUBLE": "<f8"}
_NIFTI = {2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2", 768: "u4"}
VOLUME = "path string, shape array<int>, spacing array<double>, voxels binary"


def parse_mha(data: bytes) -> tuple[np.ndarray, tuple[float, ...]]:
    """Array (slices, rows, columns) and spacing in the same order of a single-file MetaImage."""
    header: dict[str, str] = {}
    at = 0
    while "ElementDataFile" not in header:
        end = data.index(b"\n", at)
        name, _, value = data[at:end].decode("latin-1").partition("=")
        header[name.strip()] = value.strip()
        at = end + 1
    size = [int(x) for x in header["DimSize"].split()]
    dtype = np.dtype(_MET[header["ElementType"]])
    if header.get("BinaryDataByteOrderMSB", header.get("ElementByteOrderMSB", "False")).lower() == "true":
        dtype = dtype.newbyteorder(">")
    body = data[at:]
    if header.get("CompressedData", "False").lower() == "true":
        body = zlib.decompress(body)
    array = np.frombuffer(body, dtype, count=int(np.prod(size))).reshape(size[::-1])
    spacing = [float(x) for x in header.get("ElementSpacing", header.get("ElementSize", " ".join(["1"] * len(size)))).split()]
    return array, tuple(spacing[::-1])


def write_mha(array: np.ndarray, spacing: tuple[float, ...]) -> bytes:
    """A MetaImage of 16-bit integers."""
    head = f"ObjectType = Image\nNDims = {array.ndim}\nBinaryData = True\nBinaryDataByteOrderMSB = False\nCompressedData = False\nElementSpacing = {' '.join(str(x) for x in spacing[::-1])}\nDimSize = {' '.join(str(x) for x in array.shape[::-1])}\nElementType = MET_SHORT\nElementDataFile = LOCAL\n"
    return head.encode() + np.ascontiguousarray(np.rint(array), "<i2").tobytes()


def parse_nifti(data: bytes) -> tuple[np.ndarray, tuple[float, ...]]:
    """Array with slope and intercept applied, and spacing."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    order = "<" if struct.unpack("<i", data[:4])[0] == 348 else ">"
    dim = struct.unpack(order + "8h", data[40:56])
    kind = struct.unpack(order + "h", data[70:72])[0]
    pixdim = struct.unpack(order + "8f", data[76:108])
    offset, slope, inter = struct.unpack(order + "3f", data[108:120])
    shape = dim[1 : 1 + dim[0]]
    array = np.frombuffer(data, np.dtype(order + _NIFTI[kind]), count=int(np.prod(shape)), offset=int(offset)).reshape(shape, order="F").astype(np.float32)
    if slope not in (0.0,) and np.isfinite(slope):
        array = array * np.float32(slope) + np.float32(inter)
    return array, tuple(pixdim[1 : 1 + dim[0]])


def read_volumes(spark: SparkSession, directory: str) -> DataFrame:
    """(path, shape, spacing, voxels) of ``.mha``, ``.nii`` and ``.nii.gz`` files, and of the members of ``.zip``s."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory).select("path", "content")
    wanted = F.lower("path")
    files = files.where(wanted.endswith(".mha") | wanted.endswith(".nii") | wanted.endswith(".nii.gz") | wanted.endswith(".zip"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def volumes(path: str, content: bytes):
            low = path.lower()
            if low.endswith(".zip"):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(z.namelist()):
                        if name.lower().endswith(".mha"):
                            yield f"{path}!{name.rpartition('/')[2]}", parse_mha(z.read(name))
            else:
                yield path, parse_mha(content) if low.endswith(".mha") else parse_nifti(content)

        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for name, (array, spacing) in volumes(path, content.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([list(array.shape)], pa.list_(pa.int32())), pa.array([list(spacing)], pa.list_(pa.float64())), pa.array([np.ascontiguousarray(array, "<f4").tobytes()], pa.binary())], ["path", "shape", "spacing", "voxels"])

    return files.mapInArrow(decode, VOLUME)


def read_npz(spark: SparkSession, directory: str, name: str = "arr") -> DataFrame:
    """(key, vector): the named array of each NPZ file, flattened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(directory).select("path", "content")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys.append(path.rpartition("/")[2].removesuffix(".npz"))
                rows.append(np.load(io.BytesIO(content.as_py()), allow_pickle=False)[name].ravel().astype(float).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(rows, pa.list_(pa.float64()))], ["key", "vector"])

    return files.mapInArrow(decode, "key string, vector array<double>")
