"""The document table: commits of change rows on parquet, read back as current documents.

Every write is one commit folder of put, delete and reject rows, named by its
writer, so that writing it again replaces it.  Rows carry a sequence number;
the newest put of an id counts unless a newer delete covers it, whichever of
them was written first.  A base takes commits in: it holds the current documents,
bucketed by source row, and the deletes and rejects, so that what comes late
still meets what is newer than it.  A source row with very many documents stands
in several slices, so that no bucket and no task holds all of them.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import CHANGE_SCHEMA, DEL_KEY, DEL_TENANT, DEL_TYPE, DOC_SCHEMA, PUT, REJECT
from ..session import broadcast_if_small

KEY = ["client_id", "module", "id"]
#: The source row of a document, by whose slices a base is bucketed.
ROW = ["client_id", "doc_type", "source_id"]
SLICE = [*ROW, "slice"]
#: Documents of a slice of a source row, about, which are met as one map; a row with no more has one slice.
SLICE_ROWS = 1000
#: Documents of a bucket, about, and the most buckets a base has.
BUCKET_ROWS, MOST_BUCKETS = 100_000, 8192
#: Tries at a sequence number or a head before giving up.
TRIES = 1000


def as_changes(rows: DataFrame, kind: str, seq: int) -> DataFrame:
    """Rows in the stored layout, their kind a SQL expression; fields a row does not have are null."""
    given = [f"`{c}`" for c in rows.columns if c in CHANGE_SCHEMA.names and c not in ("kind", "seq")]
    number = f"if(({kind}) in ('{PUT}', '{REJECT}'), {seq + 1}L, {seq}L)"
    return rows.selectExpr(*given, f"{kind} as kind", f"{number} as seq").to(CHANGE_SCHEMA)


#: What each kind of delete covers.
SCOPES = {
    DEL_KEY: ROW,
    DEL_TYPE: ["client_id", "doc_type"],
    DEL_TENANT: ["client_id"],
}


def newest_puts(changes: DataFrame) -> DataFrame:
    """One put per document id; each task drops older ones before rows move."""
    newest = Window.partitionBy(*KEY).orderBy(F.col("seq").desc())
    puts = changes.filter(F.col("kind") == PUT)
    return puts.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def deletes_of(changes: DataFrame, kind: str) -> DataFrame:
    """(scope…, seq) of the newest delete of each scope."""
    scope = SCOPES[kind]
    return changes.filter(F.col("kind") == kind).groupBy(*scope).agg(F.max("seq").alias("seq"))


def _not_deleted(rows: DataFrame, changes: DataFrame, kind: str) -> DataFrame:
    """Rows that no newer delete of a kind covers; deletes go to the rows while they are few."""
    scope = SCOPES[kind]
    deleted = deletes_of(changes, kind).withColumnRenamed("seq", "_deleted")
    return rows.join(broadcast_if_small(deleted), scope, "left").filter("seq > coalesce(_deleted, -1)").drop("_deleted")


@dataclass(frozen=True)
class Slices:
    """How the documents of a base are dealt: ``many`` (source row..., slices) names the rows of more than one slice."""

    many: DataFrame
    buckets: int

    def _with_count(self, rows: DataFrame) -> DataFrame:
        return rows.join(broadcast_if_small(self.many), ROW, "left")

    def of_documents(self, rows: DataFrame) -> DataFrame:
        """``rows`` (source row, module, id) with the ``slice`` each is in."""
        own = F.pmod(F.xxhash64("module", "id"), F.col("slices")).cast("int")
        return self._with_count(rows).withColumn("slice", F.coalesce(own, F.lit(0))).drop("slices")

    def of_rows(self, rows: DataFrame) -> DataFrame:
        """``rows`` (source row) once for each slice of their documents."""
        slices = F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)
        return self._with_count(rows).withColumn("slice", F.explode(slices)).drop("slices")

    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` (slice) to the tasks of the buckets, so that they meet a base that stays where it is."""
        return rows.repartition(self.buckets, *SLICE)


def buckets_for(documents: int) -> int:
    """Buckets of a base: a bucket's documents, over a hundred columns wide, are sorted and met in one task, so it holds few."""
    return min(MOST_BUCKETS, 1 << max(3, (documents // BUCKET_ROWS).bit_length()))


def many_sliced(rows: DataFrame) -> DataFrame:
    """(source row..., slices int) of the source rows with more documents than a slice holds; each task counts its own first."""
    counts = rows.groupBy(*ROW).count().filter(F.col("count") > SLICE_ROWS)
    return counts.select(*ROW, F.ceil(F.col("count") / SLICE_ROWS).cast("int").alias("slices"))


def _slot() -> Column:
    return F.concat_ws("/", "module", "id")


def _per_place(rows: DataFrame, place: list[str]) -> DataFrame:
    """(place..., _seqs): sequence numbers of the documents of a slice by id."""
    return rows.groupBy(*place).agg(F.map_from_entries(F.collect_list(F.struct(_slot(), "seq"))).alias("_seqs"))


def _other_seq() -> Column:
    """The sequence number the same document has on the other side, null where it has none."""
    return F.element_at("_seqs", _slot())


def current_documents(
    changes: DataFrame, base: DataFrame | None = None, base_marks: DataFrame | None = None, slices: Slices | None = None
) -> DataFrame:
    """Live documents: newest put per id, less those a later delete covers.

    ``base`` holds documents already reduced to one per id, and ``base_marks``
    the deletes among the changes it has taken in.  Documents of the base and
    changes meet by slice of a source row; whichever has the greater sequence
    number counts, and of equal ones the change.  A stored base is bucketed by
    its ``slices`` and not shuffled however many rows have changed; a delete goes
    to all slices of its row.  Slices are made when a base is written, so a row
    that has few documents in it and gets very many new ones in the changes is
    met as one until the next base.
    """
    columns = [c for c in changes.columns if c not in ("kind", "reason")]
    puts = newest_puts(changes).select(*columns)
    deletes = changes.filter(F.col("kind").isin(list(SCOPES))).select(*ROW, "kind", "seq")
    if base_marks is not None:
        deletes = deletes.unionByName(base_marks.filter(F.col("kind").isin(list(SCOPES))).select(*ROW, "kind", "seq"))
    if base is None:
        for kind in SCOPES:
            puts = _not_deleted(puts, deletes, kind)
        return puts
    place = ROW if slices is None else SLICE
    gone = deletes_of(changes, DEL_KEY).withColumnRenamed("seq", "_deleted")
    if slices is not None:
        gone, puts = slices.dealt(slices.of_rows(gone)), slices.dealt(slices.of_documents(puts))
    kept = base.select(*dict.fromkeys([*columns, *place]))
    stays = kept.join(gone, place, "left").join(_per_place(puts, place), place, "left").filter(
        (F.col("seq") > F.coalesce("_deleted", F.lit(-1))) & F.coalesce(F.col("seq") > _other_seq(), F.lit(True))
    )
    touched = kept.select(*place, "module", "id", "seq").join(puts.select(*place).distinct(), place, "left_semi")
    puts = puts.join(_per_place(touched, place), place, "left").filter(F.coalesce(F.col("seq") >= _other_seq(), F.lit(True)))
    rows = stays.select(*columns).unionByName(_not_deleted(puts.select(*columns), deletes, DEL_KEY))
    for kind in (DEL_TYPE, DEL_TENANT):
        rows = _not_deleted(rows, deletes, kind)
    return rows


def marks_of(changes: DataFrame) -> DataFrame:
    """Deletes, the newest of each scope, and the newest reject of each refused row, as change rows."""
    rejects = changes.filter(F.col("kind") == REJECT)
    newest = rejects.groupBy("client_id", "module", "doc_type", "source_id", "id", "reason", "kind").agg(F.max("seq").alias("seq"))
    kept = newest.to(CHANGE_SCHEMA)
    for kind, scope in SCOPES.items():
        deletes = changes.filter(F.col("kind") == kind).groupBy(*scope, "kind").agg(
            F.max("seq").alias("seq"), *([F.first("module").alias("module")] if kind != DEL_TENANT else [])
        )
        kept = kept.unionByName(deletes.to(CHANGE_SCHEMA))
    return kept


def reduced(changes: DataFrame) -> DataFrame:
    """Changes that say the same in fewer rows: the newest put per id, delete per scope and reject per row."""
    return newest_puts(changes).to(CHANGE_SCHEMA).unionByName(marks_of(changes))


@dataclass(frozen=True)
class DocumentStore:
    spark: SparkSession
    root: str

    def next_seq(self) -> int:
        """A number greater than all given out before, by any driver: a delete's; puts of its commit take the next one.

        Numbers are files made under a name that must be new.
        """
        fs, folder = self._at("seqs")
        fs.mkdirs(folder)
        for _ in range(TRIES):
            given = [int(s.getPath().getName()) for s in fs.listStatus(folder)]
            number = max([time.time_ns() // 1000 * 2, *(n + 2 for n in given)])
            if fs.createNewFile(self._at(f"seqs/{number}")[1]):
                for n in sorted(given)[:-100]:
                    fs.delete(self._at(f"seqs/{n}")[1], False)
                return number
        raise RuntimeError(f"no sequence number could be taken under {self.root}")

    def commit(self, changes: DataFrame, name: str) -> str:
        """Write one commit of even files; the same name again replaces it.

        Rows of a tenant and index come together, so that readers of some skip the rest by the files' statistics.
        """
        if name in self._head()[1]:
            name = f"{name}-{uuid.uuid4().hex[:8]}"
        changes = changes.to(CHANGE_SCHEMA).hint("rebalance", "client_id", "module").sortWithinPartitions("client_id", "module", "kind")
        changes.write.mode("overwrite").parquet(self._commit_path(name))
        return name

    def read(self, names: list[str]) -> DataFrame:
        """Change rows of the named commits."""
        if not names:
            return self.spark.createDataFrame([], CHANGE_SCHEMA)
        return self.spark.read.schema(CHANGE_SCHEMA).parquet(*[self._commit_path(n) for n in names])

    def changes(self) -> DataFrame:
        """Change rows of the finished commits that are not taken in elsewhere."""
        return self.read(self._open_commits())

    def commits(self) -> list[str]:
        return [n.partition("=")[2] for n in self._finished("commits")]

    def base(self) -> DataFrame | None:
        """The documents of the base in force."""
        name = self._head()[0]
        return None if name is None else self._base_documents(name)

    def slices(self) -> Slices | None:
        """How the base in force is dealt."""
        name = self._head()[0]
        if name is None:
            return None
        many = ", ".join(f"`{c}` {CHANGE_SCHEMA[c].dataType.simpleString()}" for c in ROW) + ", slices int"
        return Slices(self.spark.read.schema(many).parquet(f"{self.root}/bases/{name}/slices"), self._buckets(name)[1])

    def base_marks(self) -> DataFrame | None:
        """The deletes and rejects the base has taken in."""
        name = self._head()[0]
        return None if name is None else self.spark.read.schema(CHANGE_SCHEMA).parquet(f"{self.root}/bases/{name}/marks")

    def snapshot(self, client_id: str | None = None, module: str | None = None) -> DataFrame:
        """Current documents, of one tenant or index if named."""
        parts = [self.changes(), self.base(), self.base_marks()]
        if client_id is not None:
            parts = [p if p is None else p.filter(F.col("client_id") == client_id) for p in parts]
        if module is not None:
            parts = [p if p is None else p.filter((F.col("module") == module) | (F.col("kind") == DEL_TENANT)) for p in parts]
        return current_documents(*parts, self.slices()).select("client_id", "seq", *DOC_SCHEMA.fieldNames())

    def rejects(self) -> DataFrame:
        """Rows refused, those the base has taken in too."""
        changes, marks = self.changes(), self.base_marks()
        rows = changes if marks is None else changes.unionByName(marks)
        return rows.filter(F.col("kind") == REJECT).select("client_id", "doc_type", "source_id", "id", "reason", "seq")

    def merge(self) -> None:
        """Put the open commits into one, so that a stream's many small commits stay few to list and read."""
        names = self._open_commits()
        if not names:
            return
        merged = self.commit(reduced(self.read(names)), f"merged-{_stamp()}")
        self._change_head(lambda base, taken: (base, (taken | set(names)) - {merged}))

    def compact(self) -> None:
        """Write the current documents, and the deletes and rejects so far, as a new base that takes in all commits.

        Where another driver has put a base in force meanwhile, that one stays and this one is given up.
        """
        before, finished, name = self._head()[0], self.commits(), f"{_stamp()}-{uuid.uuid4().hex[:8]}"
        changes, base, marks = self.changes(), self.base(), self.base_marks()
        rows = current_documents(changes, base, marks, self.slices()).withColumn("kind", F.lit(PUT)).withColumn("reason", F.lit(None).cast("string"))
        marks_of(changes if marks is None else changes.unionByName(marks)).write.parquet(f"{self.root}/bases/{name}/marks")
        known = self._table(name, "staged")
        rows.to(CHANGE_SCHEMA).write.mode("overwrite").parquet(f"{self.root}/bases/{name}/staged")
        staged = self.spark.read.schema(CHANGE_SCHEMA).parquet(f"{self.root}/bases/{name}/staged")
        buckets = buckets_for(staged.count())
        path = f"{self.root}/bases/{name}/documents-{buckets}"
        many_sliced(staged).write.mode("overwrite").parquet(f"{self.root}/bases/{name}/slices")
        slices = Slices(self.spark.read.parquet(f"{self.root}/bases/{name}/slices"), buckets)
        # a task for each bucket, so that every bucket is one file
        dealt = slices.dealt(slices.of_documents(staged)).write.bucketBy(buckets, *SLICE).sortBy(*SLICE)
        dealt.option("path", path).mode("overwrite").saveAsTable(known)
        self.spark.sql(f"DROP TABLE IF EXISTS {known}")
        fs, left = self._at(f"bases/{name}/staged")
        fs.delete(left, True)
        self._change_head(lambda base, taken: (name, set(finished)) if base == before else (base, taken))

    def vacuum(self, older_than_seconds: float = 86_400) -> None:
        """Remove commits that are taken in, and bases and heads no longer in force, once they are old enough for no reader to need them."""
        base, taken = self._head()
        heads, before = self._heads(), (time.time() - older_than_seconds) * 1000
        old = [f"commits/commit={n}" for n in self.commits() if n in taken]
        old += [f"bases/{n}" for n in self._folders("bases") if n != base] + [f"heads/{n}" for n in heads[:-1]]
        gone = set()
        for place in old:
            fs, path = self._at(place)
            if fs.exists(path) and fs.getFileStatus(path).getModificationTime() <= before:
                fs.delete(path, True)
                gone.add(place.partition("commit=")[2])
        if taken & gone:
            self._change_head(lambda base, taken: (base, taken - gone))

    def _at(self, place: str):
        """The file system of a place under the root, and its path there."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{place}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _table(self, name: str, what: str) -> str:
        mark = re.sub(r"\W", "_", f"{uuid.uuid5(uuid.NAMESPACE_URL, self.root).hex}_{name}_{what}")
        return f"documents_{mark}"

    def _buckets(self, name: str) -> tuple[str, int]:
        """The folder of a base's documents, and the number of its buckets."""
        (folder,) = [f for f in self._folders(f"bases/{name}") if f.startswith("documents-")]
        return folder, int(folder.rpartition("-")[2])

    def _base_documents(self, name: str) -> DataFrame:
        """The bucketed documents of a base, made known to this session's catalog where they are not yet."""
        folder, buckets = self._buckets(name)
        table = self._table(name, "base")
        if not self.spark.catalog.tableExists(table):
            layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CHANGE_SCHEMA) + ", slice int"
            by = ", ".join(SLICE)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {table} ({layout}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS"
                f" LOCATION '{self.root}/bases/{name}/{folder}'"
            )
        return self.spark.table(table)

    def _commit_path(self, name: str) -> str:
        return f"{self.root}/commits/commit={name}"

    def _folders(self, place: str) -> list[str]:
        fs, path = self._at(f"{place}/*")
        return sorted(s.getPath().getName() for s in fs.globStatus(path) or [])

    def _finished(self, folder: str) -> list[str]:
        """Names of the sub-folders whose write has finished."""
        fs, path = self._at(f"{folder}/*/_SUCCESS")
        return sorted(s.getPath().getParent().getName() for s in fs.globStatus(path) or [])

    def _open_commits(self) -> list[str]:
        taken = self._head()[1]
        return [n for n in self.commits() if n not in taken]

    def _head(self) -> tuple[str | None, set[str]]:
        """The base in force and the commits it or a merged commit has taken in and that are not removed yet."""
        names = self._heads()
        return self._read_head(names[-1]) if names else (None, set())

    def _heads(self) -> list[str]:
        """Names of the heads, numbers of one width, the one in force last."""
        fs, path = self._at("heads/*")
        return sorted(s.getPath().getName() for s in fs.globStatus(path) or [])

    def _read_head(self, name: str) -> tuple[str | None, set[str]]:
        rows = self.spark.read.schema("base string, taken string").json(f"{self.root}/heads/{name}").collect()
        return rows[0]["base"], {r["taken"] for r in rows if r["taken"] is not None}

    def _change_head(self, change: Callable[[str | None, set[str]], tuple[str | None, set[str]]]) -> None:
        """Put what ``change`` makes of the head in force under the next number, which must be new.

        Where another driver has taken that number, the change is made again to
        what it has written, so no head is lost whatever the drivers' clocks say.
        A head is a whole file before it gets its name.
        """
        for _ in range(TRIES):
            names = self._heads()
            now = self._read_head(names[-1]) if names else (None, set())
            base, taken = change(*now)
            if names and (base, taken) == now:
                return
            lines = [json.dumps({"base": base, "taken": n}) for n in sorted(taken)] or [json.dumps({"base": base, "taken": None})]
            if self._put_new(f"heads/{int(names[-1]) + 1 if names else 1:020d}", "\n".join(lines)):
                return
        raise RuntimeError(f"no head could be set under {self.root}")

    def _put_new(self, place: str, content: str) -> bool:
        """Write a small file under a name that must be new; false where there is one already."""
        fs, staged = self._at(f"staged-heads/{uuid.uuid4().hex}")
        _, path = self._at(place)
        fs.mkdirs(path.getParent())
        out = fs.create(staged)
        out.write(content.encode())
        out.close()
        jvm = self.spark._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        how = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(staged, path, how)
        except Py4JJavaError as e:
            fs.delete(staged, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True


def _stamp() -> str:
    return f"{time.time_ns():020d}"
