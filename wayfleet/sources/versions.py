"""Tables of numbered, immutable versions: writers add folders, one small file switches all readers at once."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from wayfleet.sources import files


class Versions:
    """What belongs to a table, by version number, below ``<root>/versions``.

    A version is a JSON object that says which folders hold the table. Publishing a number again replaces it, so a
    step that is repeated after a failure leaves one version. Readers take the highest number.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in files.names(self.spark, f"{self.root}/versions") if n.endswith(".json")]

    def get(self, number: int) -> dict:
        return json.loads(files.read_text(self.spark, self._path(number)))

    def latest(self, below: int | None = None) -> tuple[int, dict] | None:
        """Number and content of the highest version, or of the highest below a number."""
        found = [n for n in self.numbers() if below is None or n < below]
        return (found[-1], self.get(found[-1])) if found else None

    def publish(self, number: int, content: dict) -> None:
        files.write_text(self.spark, self._path(number), json.dumps(content))

    def expire(self, keep: int) -> list[dict]:
        """Forget all but the last ``keep`` versions; returns what was forgotten."""
        gone = self.numbers()[:-keep]
        contents = [self.get(n) for n in gone]
        for n in gone:
            files.remove(self.spark, self._path(n))
        return contents

    def _path(self, number: int) -> str:
        return f"{self.root}/versions/{number:012d}.json"
