"""Table storage for the warehouse layers (S3, S7, S8) on any Hadoop-compatible file system.

No MERGE-capable table format is assumed.  A keyed table is therefore replaced as a whole:

* every write goes to a **new** version directory ``<root>/<table>/v=<n>`` through Spark's normal
  file commit, which writes ``_SUCCESS`` last;
* a reader takes the highest version holding ``_SUCCESS``; a job that dies midway leaves an
  uncommitted directory that no reader ever sees, and the previous version stays intact;
* a plan never overwrites the path it reads (the new state is computed from version n, written to
  n + 1), which is the failure mode of in-place overwrites.

A load that touches few rows of a keyed table commits those rows alone, under ``<table>/changes/c=<n>``, in
one sequence of numbers with the versions.  The state is the newest version with the newest change row of
each key in place of its own; ``fold`` writes that state as a version now and then.  Change rows may also
say how they came about and what they replaced, so that summaries follow from the changes alone.

Raw tables are append-only: each landing appends files under ``<root>/<table>/data`` partitioned by
ingest date, so recency checks prune whole directories.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.frames import no_rows
from ..operators.constraints import check_unique, default_columns, enforce_not_null
from ..operators.dedup import latest_per_key
from ..session import plain_variants

FOLD_AFTER = 8  # change sets after which a table's state is written as a whole
APPEND_ONLY = {S.RAW_REPOS.name, S.RAW_COMMITS.name}


def empty_table(spark: SparkSession, spec: S.TableSpec) -> DataFrame:
    return no_rows(spark, spec.schema)


class Warehouse:
    """Versioned parquet tables under one root folder (shared storage on a cluster)."""

    def __init__(self, spark: SparkSession, root: str, specs: dict[str, S.TableSpec] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.specs = dict(specs or S.TABLES)
        self.known_rows: dict[str, tuple[int, int]] = {}  # table -> version and rows of its state
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- paths ------------------------------------------------------------------------------
    def _table_dir(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _version_dir(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v={version:08d}"

    def _exists(self, path: str) -> bool:
        return bool(self._fs.exists(self._Path(path)))

    def _change_dir(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/changes/c={version:08d}"

    def _committed(self, folder: str, letter: str) -> list[int]:
        d = self._Path(folder)
        if not self._fs.exists(d):
            return []
        out = []
        for st in self._fs.listStatus(d):
            base = st.getPath().getName()
            if base.startswith(f"{letter}=") and self._exists(f"{st.getPath().toString()}/_SUCCESS"):
                out.append(int(base[2:]))
        return sorted(out)

    def full_versions(self, name: str) -> list[int]:
        """Committed whole versions of a keyed table, oldest first."""
        return self._committed(self._table_dir(name), "v")

    def change_versions(self, name: str) -> list[int]:
        """Committed change sets of a keyed table, oldest first."""
        return self._committed(f"{self._table_dir(name)}/changes", "c")

    def versions(self, name: str) -> list[int]:
        """Committed states of a keyed table, oldest first."""
        return sorted({*self.full_versions(name), *self.change_versions(name)})

    # -- reads ------------------------------------------------------------------------------
    def read(self, name: str, version: int | None = None) -> DataFrame:
        """Latest committed state (or a given version); an empty frame if never written."""
        spec = self.specs.get(name)
        if name in APPEND_ONLY:
            path = f"{self._table_dir(name)}/data"
            if not self._exists(path):
                return empty_table(self.spark, spec)
            # the ingest_date partition column is kept: filters on it prune directories
            schema = T.StructType([*spec.schema.fields, T.StructField("ingest_date", T.DateType())])
            return self.spark.read.schema(schema).parquet(path)
        full = [v for v in self.full_versions(name) if version is None or v <= version]
        base = full[-1] if full else 0
        sets = [c for c in self.change_versions(name) if c > base and (version is None or c <= version)]
        if not full and spec is None:
            raise KeyError(f"table {name} has no committed version")
        if full:
            reader = self.spark.read.schema(spec.schema) if spec else self.spark.read
            state = reader.parquet(self._version_dir(name, base))
        else:
            state = empty_table(self.spark, spec)
        if not sets:
            return state
        newest = self._change_rows(name, sets, spec.schema.fields)
        if len(sets) > 1:  # one set holds a key once
            newest = latest_per_key(newest, spec.keys, [F.col("c").desc()])
        newest = newest.drop("c")
        touched = newest.select(*[F.col(k).alias(f"_k_{k}") for k in spec.keys])
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in spec.keys])
        return state.join(touched, same, "left_anti").unionByName(newest)

    def _change_rows(self, name: str, sets: list[int], fields: list[T.StructField]) -> DataFrame:
        schema = T.StructType([*fields, T.StructField("c", T.IntegerType())])
        return (self.spark.read.schema(schema).option("basePath", f"{self._table_dir(name)}/changes")
                .parquet(*[self._change_dir(name, c) for c in sets]))

    def changes(self, name: str, after: int, before: Sequence[str] = ()) -> DataFrame | None:
        """Change rows of the sets after a version, with ``_op``, ``c`` (the set) and ``_old_<column>`` of the
        columns ``before``; None when a whole version came after it, which no change rows explain."""
        full = self.full_versions(name)
        if full and full[-1] > after:
            return None
        spec = self.specs[name]
        fields = [*spec.schema.fields, T.StructField("_op", T.StringType()),
                  *[T.StructField(f"_old_{b}", spec.schema[b].dataType) for b in before]]
        sets = [c for c in self.change_versions(name) if c > after]
        if not sets:
            return no_rows(self.spark, T.StructType([*fields, T.StructField("c", T.IntegerType())]))
        return self._change_rows(name, sets, fields)

    def rows(self, name: str) -> int:
        """Rows of the current state: as the writes counted them, by a scan only if others wrote."""
        vs = self.versions(name)
        if not vs:
            return 0
        known = self.known_rows.get(name)
        if known is None or known[0] != vs[-1]:
            known = self.known_rows[name] = (vs[-1], self.read(name).count())
        return known[1]

    # -- writes -----------------------------------------------------------------------------
    def _checked(self, name: str, df: DataFrame, as_of, extra: Sequence[str] = ()) -> DataFrame:
        """``df`` in the table's layout: defaults for columns it lacks, NOT NULL enforced inside the write."""
        spec = self.specs.get(name)
        if spec is None:
            return df
        missing = {c: e for c, e in spec.defaults.items() if c not in df.columns}
        for c, value in default_columns(missing, as_of).items():
            df = df.withColumn(c, value.cast(spec.schema[c].dataType))
        return enforce_not_null(df.select(*spec.columns, *extra), spec.not_null, name)

    def _next(self, name: str) -> int:
        vs = self.versions(name)
        version = (vs[-1] + 1) if vs else 1
        # a leftover directory of a crashed attempt is never read; write past it
        while self._exists(self._version_dir(name, version)) or self._exists(self._change_dir(name, version)):
            version += 1
        return version

    def replace(self, name: str, df: DataFrame, *, as_of=None, check_keys: bool = False) -> int:
        """Commit ``df`` as the next version of a keyed table; returns the version number.

        Required columns are checked while writing (a NULL fails the job before ``_SUCCESS``) and
        columns that ``df`` lacks get the table's defaults (``as_of`` stands for the run's time).
        ``check_keys`` also checks the primary key, over the written key columns and before the version
        counts as committed; the result of an upsert has unique keys already.
        """
        version = self._next(name)
        self._write_version(name, version, self._checked(name, df, as_of), check_keys)
        return version

    def _write_version(self, name: str, version: int, df: DataFrame, check_keys: bool = False) -> None:
        path, observed = self._version_dir(name, version), Observation()
        df = df.observe(observed, F.count(F.lit(1)).alias("n"))
        spec = self.specs.get(name)
        if check_keys and spec is not None and spec.keys:
            # _SUCCESS commits a version, and comes after the check
            df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
            keys = self.spark.read.schema(spec.schema).parquet(path).select(*spec.keys)
            check_unique(keys, list(spec.keys), table=name)
            self._fs.create(self._Path(f"{path}/_SUCCESS")).close()
        else:
            df.write.mode("errorifexists").parquet(path)
        self.known_rows[name] = (version, observed.get["n"])

    def append_changes(self, name: str, df: DataFrame) -> int:
        """Commit updated and inserted rows (``upsert(..., changes_only=True, before=...)``) as the next
        state of a keyed table; returns its number.  Columns beyond the table's are kept with the rows."""
        if "_op" not in df.columns:
            raise ValueError("change rows need _op: use upsert(..., changes_only=True, before=...)")
        before = self.versions(name)
        version, observed = self._next(name), Observation()
        extra = [c for c in df.columns if c not in self.specs[name].columns]
        df = self._checked(name, df, None, extra).observe(
            observed, F.count(F.when(F.col("_op") == "I", 1)).alias("n"))
        df.write.mode("errorifexists").parquet(self._change_dir(name, version))
        known = self.known_rows.get(name)
        if not before:
            self.known_rows[name] = (version, observed.get["n"])
        elif known is not None and known[0] == before[-1]:
            self.known_rows[name] = (version, known[1] + observed.get["n"])
        return version

    def fold(self, name: str, sets: int = FOLD_AFTER) -> bool:
        """Write the state as a whole version once it has ``sets`` change sets.  The version takes the last
        set's number: the state is the same, so what follows the table by number has nothing to redo."""
        full, vs = self.full_versions(name), self.versions(name)
        if sum(c > (full[-1] if full else 0) for c in self.change_versions(name)) < max(sets, 1):
            return False
        state, path = self.read(name), self._Path(self._version_dir(name, vs[-1]))
        if self._fs.exists(path):  # left by a fold that died; never read
            self._fs.delete(path, True)
        self._write_version(name, vs[-1], state)
        return True

    def reset(self, name: str) -> None:
        """Remove a derived table; its owner builds it anew."""
        self._fs.delete(self._Path(self._table_dir(name)), True)
        self.known_rows.pop(name, None)

    def append(self, name: str, df: DataFrame, *, as_of=None) -> None:
        """Append rows to a raw (append-only) table, partitioned by ingest date."""
        df = self._checked(name, df, as_of)
        with plain_variants(self.spark):
            (df.withColumn("ingest_date", F.to_date("ingested_at"))
               .write.mode("append").partitionBy("ingest_date")
               .parquet(f"{self._table_dir(name)}/data"))

    def ensure_tables(self, names: Iterable[str] | None = None) -> None:
        """Create the folder of every table that does not exist yet.

        No data is written: a table without a committed version reads as an empty frame with its
        declared schema, so creation needs no Spark job.
        """
        for name in names or [t.name for t in S.ALL_TABLES]:
            self._fs.mkdirs(self._Path(self._table_dir(name)))

    def vacuum(self, name: str, keep: int = 2) -> list[int]:
        """Delete what the newest ``keep`` committed states do not need, and what crashed writes below the
        newest left uncommitted; returns the deleted committed versions and change sets.

        Readers still scanning a deleted version would fail, so run it after the jobs that read the
        table (the pipeline does, at the end of a successful run)."""
        vs, full, sets = self.versions(name), self.full_versions(name), self.change_versions(name)
        if not vs:
            return []
        oldest = vs[-keep:][0] if keep > 0 else vs[-1] + 1
        base = max([v for v in full if v <= oldest], default=0) if keep > 0 else oldest
        gone = []
        for folder, letter, committed, first in ((self._table_dir(name), "v", full, base),
                                                 (f"{self._table_dir(name)}/changes", "c", sets, base + 1)):
            if not self._exists(folder):
                continue
            for st in self._fs.listStatus(self._Path(folder)):
                label = st.getPath().getName()
                if not label.startswith(f"{letter}="):
                    continue
                number = int(label[2:])
                if number in committed and number < first:
                    gone.append(number)
                elif number in committed or number >= vs[-1]:
                    continue
                self._fs.delete(st.getPath(), True)
        return sorted(gone)
