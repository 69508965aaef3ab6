"""Outputs of a job that are replaced all at once.

A job writes its outputs into a fresh version folder. Only when all of them stand does a small numbered
manifest name that folder; readers follow the manifest with the largest number. A manifest
is written aside and then renamed to its number, which a Hadoop file system does in one step and
refuses where the name is taken, so a reader sees the old set or the new one, whole. A job that fails leaves the old set
as it was.

    <root>/versions/<id>/...      the outputs of one run
    <root>/manifests/<number>     which version counts, and its outputs
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from pulsegrid.session import remove_path


class Releases:
    """The releases under ``root``, a folder on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._path(os.path.join(self.root, folder))
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def numbers(self) -> list[int]:
        """Numbers of the published releases, oldest first."""
        return [int(n) for n in self._names("manifests") if n.isdigit()]

    def read(self, number: int) -> dict:
        """The manifest of a release: its number, ``version``, ``outputs`` (name -> path) and whatever was noted with it."""
        text = self.spark.read.text(os.path.join(self.root, "manifests", f"{number:012d}"), wholetext=True).first()[0]
        found = json.loads(text)
        # paths are kept relative, so that a root can be moved or reached under another name
        found["outputs"] = {name: os.path.join(self.root, path) for name, path in found["outputs"].items()}
        return found | {"number": number}

    def current(self) -> dict | None:
        """The manifest that counts; None before the first release."""
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    @contextmanager
    def new(self) -> Iterator[str]:
        """The folder of a new version; it is removed again if what is done in it fails."""
        path = os.path.join(self.root, "versions", uuid.uuid4().hex)
        try:
            yield path
        except BaseException:
            remove_path(self.spark, path)
            raise

    def publish(self, version: str, outputs: dict[str, str], **noted) -> int:
        """Make the outputs (paths below ``version``) those that count; returns the release's number."""
        body = {"version": os.path.basename(version), "outputs": {k: os.path.relpath(p, self.root) for k, p in outputs.items()}} | noted
        folder = os.path.join(self.root, "manifests")
        self._fs.mkdirs(self._path(folder))
        aside = self._path(os.path.join(folder, f"_{uuid.uuid4().hex}"))
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps(body).encode()))
        out.close()
        while True:
            number = max(self.numbers(), default=0) + 1
            target = self._path(os.path.join(folder, f"{number:012d}"))
            # someone else may publish at the same time: the name is then taken, and the next one is tried
            if not self._fs.exists(target) and self._fs.rename(aside, target):
                return number

    def retire(self, keep: int = 2) -> list[int]:
        """Remove all but the last ``keep`` releases, manifests first; returns the numbers removed.

        Versions without a manifest stay: a job may be at work in them.
        """
        old = self.numbers()[: -max(1, keep)]
        kept = {self.read(n)["version"] for n in self.numbers()[-max(1, keep) :]}
        for number in old:
            version = self.read(number)["version"]
            remove_path(self.spark, os.path.join(self.root, "manifests", f"{number:012d}"))
            if version not in kept:
                remove_path(self.spark, os.path.join(self.root, "versions", version))
        return old
