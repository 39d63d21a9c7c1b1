"""SHA-256 digests of files of any size, hashed in chunks by one task per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "relative string, path string, bytes long, sha256 string"
CHUNK = 8 << 20


def _store(root: str):
    """File system and path of a folder or file; any store that the installed Arrow reaches."""
    from pyarrow import fs

    if "://" not in root and not root.startswith("file:"):
        return fs.LocalFileSystem(), root.rstrip("/")
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root[len("file:"):].strip("/")
    store, path = fs.FileSystem.from_uri(root)
    return store, path.rstrip("/")


class OneFile(InputPartition):
    """A file below the folder."""

    def __init__(self, relative: str, path: str):
        super().__init__(path)
        self.relative, self.path = relative, path


class DigestReader(DataSourceReader):
    """Lists the folder when the scan is planned, as every file scan does, and hashes each file where its task runs."""

    def __init__(self, root: str):
        self.root = root

    def partitions(self) -> list[OneFile]:
        from pyarrow import fs

        store, folder = _store(self.root)
        found = store.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
        hidden = lambda name: any(part[:1] in "._" for part in name.split("/"))
        names = ((f.path, f.path[len(folder) + 1:]) for f in found if f.type == fs.FileType.File)
        return [OneFile(relative, path) for path, relative in names if not hidden(relative)]

    def read(self, partition: OneFile | None):
        import hashlib

        if partition is None:  # a folder without files
            return
        store, _ = _store(self.root)
        digest, size = hashlib.sha256(), 0
        with store.open_input_stream(partition.path) as stream:
            while chunk := stream.read(CHUNK):
                digest.update(chunk)
                size += len(chunk)
        yield partition.relative, partition.path, size, digest.hexdigest()


class DigestSource(DataSource):
    """``spark.read.format("fluxsieve_digests").load(folder)``: relative, path, bytes, sha256 of every file below it."""

    @classmethod
    def name(cls) -> str:
        return "fluxsieve_digests"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DigestReader:
        return DigestReader(self.options["path"])


def folder_digests(spark: SparkSession, root: str) -> DataFrame:
    """(relative, path, bytes, sha256) of every file below a folder; names that begin with ``.`` or ``_`` are left out."""
    spark.dataSource.register(DigestSource)
    return spark.read.format(DigestSource.name()).load(root)
