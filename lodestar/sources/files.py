"""Extract scans and file discovery (SRC1-6, SRC11)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_COL = "_file"


def _header_groups(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The CSV files grouped by their header line (read through Hadoop's file
    systems, a few at a time: one line per file reaches the driver)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def files_of(path: str) -> list[str]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        statuses = fs.globStatus(p)
        if not statuses:
            raise FileNotFoundError(path)
        return [f for st in statuses for f in (_listed(spark, st.getPath().toString()) if st.isDirectory()
                                               else [st.getPath().toString()])]

    def header(path: str) -> str | None:
        p = jvm.org.apache.hadoop.fs.Path(path)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        stream = p.getFileSystem(conf).open(p)
        try:
            plain = codec.createInputStream(stream) if codec is not None else stream
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
        finally:
            stream.close()

    flat = [f for path in paths for f in files_of(path)]
    with ThreadPoolExecutor(8) as pool:
        lines = list(pool.map(header, flat))
    groups: dict[str, list[str]] = {}
    for path, line in zip(flat, lines):
        if line is not None:  # an empty file has no rows and no names
            groups.setdefault(line.lstrip("\ufeff"), []).append(path)
    return list(groups.values())


def read_source(
    spark: SparkSession,
    fmt: str,
    paths: list[str] | str,
    sep: str = ",",
    header: bool = True,
    with_file: bool = False,
    root: str | None = None,
    corrupt: str | None = None,
) -> DataFrame:
    """Read extract files in one scan (all files of a load form one job).

    CSV: header from each file, delimiter, escape backslash, every column a
    string (no schema inference).  Files with the same header form one scan; files
    whose columns stand in another order are joined by name, and a file that lacks
    a column of the others raises with its name.  ORC / Parquet: columns by name
    over all files' schemas; a column missing in a file is NULL there.  An
    object-store root (``s3a://bucket/entity``) is just another path: ``root`` is
    put before relative paths.  ``corrupt`` names a column that holds a CSV line which
    has more or fewer columns than its header (else NULL)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("no source files")
    if root:
        paths = [p if "://" in p or p.startswith(("/", "file:")) else f"{root.rstrip('/')}/{p}" for p in paths]
    fmt = fmt.removeprefix("s3-")
    if fmt == "csv":
        reader = spark.read.options(sep=sep, header=header, escape="\\", inferSchema=False)
        groups = _header_groups(spark, paths) if header else [paths]
        parts = [reader.csv(group or paths) for group in groups or [paths]]
        if corrupt:
            parts = [reader.option("columnNameOfCorruptRecord", corrupt).schema(
                ", ".join(f"`{c}` STRING" for c in [*part.columns, corrupt])).csv(group or paths)
                for part, group in zip(parts, groups or [paths])]
        df = _by_name(parts, groups)
    elif fmt in ("orc", "parquet"):
        df = spark.read.format(fmt).option("mergeSchema", "true").load(paths)
        parts = [df]
    else:
        raise ValueError(f"unknown source format {fmt!r}")
    if with_file:
        df = _by_name([p.withColumn(FILE_COL, F.col("_metadata.file_path")) for p in parts], None)
    return df


def _by_name(parts: list[DataFrame], groups: list[list[str]] | None) -> DataFrame:
    names = list(dict.fromkeys(c for part in parts for c in part.columns))
    for i, part in enumerate(parts):
        lacking = [c for c in names if c not in part.columns]
        if lacking:
            raise ValueError(f"{groups[i][0] if groups else 'a file'} lacks column(s) {', '.join(lacking)}")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Data files below a folder, names starting with '_' or '.' left out at any level."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    base = fs.getFileStatus(path).getPath().toString().rstrip("/")
    found, files = [], fs.listFiles(path, True)
    while files.hasNext():
        name = files.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in name[len(base):].strip("/").split("/")):
            found.append(name)
    return sorted(found)


def source_files(spark: SparkSession, root: str, n: str = "0") -> DataFrame:
    """SRC6: all data files under ``root/t<n>`` (or ``root`` for n='0').

    The file system is listed once (names only, whatever the files' sizes); names
    starting with '_' or '.' such as _SUCCESS are skipped.  Returns ``file``
    (full URI)."""
    folder = root.rstrip("/") if n == "0" else f"{root.rstrip('/')}/t{n}"
    return file_list(spark, _listed(spark, folder))


def file_list(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A given list of files as ``source_files`` returns it."""
    return spark.createDataFrame([(p,) for p in paths], "file string")


def stage(df: DataFrame, name: str) -> DataFrame:
    """SRC11: staged source as a named relation."""
    df.createOrReplaceTempView(name)
    return df
