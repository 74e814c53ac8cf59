"""What the stages of a job have published: versions in places of their own, each with a manifest written last.

An attempt of a stage writes where nothing was written before: the first into the job's folder itself, later ones below
``attempts``. When all of it is written, one record names the version, its place, the versions that it was made from,
the day of ages and the stage's numbers. Readers go by these records alone, so an attempt that dies changes nothing for
them, and a version that others are reading is never written over.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from veritide.sources.tables import exists

MANIFEST = "stage string, version bigint, place string, as_of string, made_from map<string,bigint>, details map<string,string>"


class OutdatedInputs(ValueError):
    """The stored results that a stage would read do not belong together."""


@dataclass(frozen=True)
class Version:
    stage: str
    version: int
    place: str
    as_of: str
    made_from: dict[str, int]


@dataclass(frozen=True)
class Published:
    """The manifests below a job's ``folder``, which all executors reach."""

    spark: SparkSession
    folder: str

    def manifest(self) -> DataFrame:
        """A row for each version of each stage."""
        if not exists(self.spark, f"{self.folder}/manifest"):
            return self.spark.createDataFrame([], MANIFEST)
        # A record's one file gets its name when it is whole.
        return self.spark.read.schema(MANIFEST).json(f"{self.folder}/manifest/*/part-*")

    def last(self) -> dict[str, Version]:
        """The last version of each stage that has one; a few rows for each run."""
        rows = self.manifest().select("stage", "version", "place", "as_of", "made_from").collect()
        newest: dict[str, Version] = {}
        for row in sorted(rows, key=lambda r: (r.version, r.place)):
            newest[row.stage] = Version(*row)
        return newest

    def new_place(self, folders: list[str]) -> str:
        """Where an attempt may write these folders: nothing is there yet."""
        used = any(exists(self.spark, f"{self.folder}/{name}") for name in folders)
        return f"{self.folder}/attempts/{uuid.uuid4().hex}" if used else self.folder

    def publish(self, stage: str, place: str, as_of: dt.date, inputs: dict[str, Version], details: dict) -> int:
        """Makes what lies at ``place`` the stage's last version."""
        before = self.last().get(stage)
        number = before.version + 1 if before else 1
        made_from = {name: v.version for name, v in inputs.items()}
        row = (stage, number, place, as_of.isoformat(), made_from, {k: str(v) for k, v in details.items()})
        record = self.spark.createDataFrame([row], MANIFEST).coalesce(1)
        record.write.json(f"{self.folder}/manifest/{stage}-{number}")
        return number

    def inputs(self, stage: str, needed: list[str], as_of: dt.date, same_day: list[str]) -> dict[str, Version]:
        """The last versions of the stages that ``stage`` reads, checked to belong together.

        They must have been published, every input of an input that is read as well must be that version, and those in
        ``same_day`` must have been made with the same ``as_of``.
        """
        last = self.last()
        if missing := [n for n in needed if n not in last]:
            raise OutdatedInputs(f"{stage} needs {', '.join(missing)} to have run")
        chosen = {n: last[n] for n in needed}
        for name, version in chosen.items():
            for origin, number in version.made_from.items():
                if origin in last and last[origin].version != number:
                    raise OutdatedInputs(
                        f"{stage} reads {name}, made from version {number} of {origin}, which is at {last[origin].version}"
                    )
            if name in same_day and version.as_of != as_of.isoformat():
                raise OutdatedInputs(f"{stage} takes ages at {as_of}, {name} at {version.as_of}")
        return chosen
