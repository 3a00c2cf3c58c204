"""Small files and folders on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        system, place = self._at(folder)
        if not system.exists(place):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(place))

    def read(self, path: str) -> str:
        system, place = self._at(path)
        stream = system.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A new file; one that is there already is an error."""
        system, place = self._at(path)
        stream = system.create(place, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, path: str, new: str) -> bool:
        system, place = self._at(path)
        return system.rename(place, self._jvm.org.apache.hadoop.fs.Path(new))

    def remove(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)
