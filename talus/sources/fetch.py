"""Fetching documents: a host's requests in one task and apart in time, retries, and manifest rows for what came of each."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import drive_id

#: Statuses worth another attempt.
AGAIN = (429, 500, 502, 503, 504)
FETCHED = "id string, status string, http_status int, final_url string, content_type string, disposition string, content binary, bytes long, sha256 string, error string"


class Response(NamedTuple):
    status: int
    url: str
    headers: dict[str, str]
    content: bytes


Get = Callable[[str], Response]


def attempt(get: Get, url: str, tries: int = 3, wait: float = 3.0, sleep: Callable[[float], None] = time.sleep) -> Response:
    """The response of a url. Refusals worth it and connection errors are tried again, each wait longer by `wait` seconds."""
    for k in range(1, tries + 1):
        try:
            response = get(url)
            if response.status not in AGAIN or k == tries:
                return response
        except OSError:
            if k == tries:
                raise
        sleep(wait * k)
    raise AssertionError("not reached")


class Kept:
    """Responses kept as files of a folder, one for each id and url, so that a task that runs again asks for none twice. Whole files only: each is written aside and
    moved to its name."""

    def __init__(self, folder: str):
        self.where, self.folder = fs.FileSystem.from_uri(folder)

    def _path(self, id_: str, url: str) -> str:
        return f"{self.folder}/{hashlib.sha256(f'{id_} {url}'.encode()).hexdigest()}"

    def get(self, id_: str, url: str) -> Response | None:
        try:
            with self.where.open_input_stream(self._path(id_, url)) as f:
                raw = f.read()
        except FileNotFoundError:
            return None
        size = int.from_bytes(raw[:8], "big")
        status, final, headers = json.loads(raw[8 : 8 + size])
        return Response(status, final, headers, raw[8 + size :])

    def put(self, id_: str, url: str, r: Response) -> None:
        head = json.dumps([r.status, r.url, r.headers]).encode()
        save_bytes(self.where, self._path(id_, url), len(head).to_bytes(8, "big") + head + r.content)


def save_bytes(where: fs.FileSystem, path: str, content: bytes) -> None:
    """A file with the content: written beside its place and moved there, over an older one."""
    where.create_dir(path.rsplit("/", 1)[0], recursive=True)
    aside = f"{path}.{uuid.uuid4().hex}"
    with where.open_output_stream(aside) as f:
        f.write(content)
    where.move(aside, path)


def fetch(work: DataFrame, get: Get, spacing: float = 1.5, tries: int = 3, kept: str | None = None) -> DataFrame:
    """One row for each of work (id, url): what was fetched, or why not.

    Work is dealt by host, so that a host's requests are made by one task and `spacing` seconds apart. A task takes one request of each of its hosts
    in turn, so that a host with very many does not hold up the others, and waits seldom. `get` is the caller's: there is no network
    client here. kept: a folder for responses, from which a task that is run again takes those that are there; without it a
    lost task's requests are made again.
    """

    def run(batches) -> Iterator:
        import pandas as pd

        there = Kept(kept) if kept else None
        last: dict[str, float] = {}
        for pdf in batches:
            rows = []
            for id_, url, host in zip(pdf["id"], pdf["url"], pdf["host"], strict=True):
                try:
                    r = there.get(id_, url) if there else None
                    if r is None:
                        time.sleep(max(0.0, last.get(host, 0.0) + spacing - time.monotonic()))
                        try:
                            r = attempt(get, url, tries)
                        finally:
                            last[host] = time.monotonic()
                        if there:
                            there.put(id_, url, r)
                    ok = r.status < 400
                    rows.append((id_, "ok" if ok else "failed", r.status, r.url, r.headers.get("Content-Type", ""), r.headers.get("Content-Disposition", ""), r.content if ok else None, len(r.content), hashlib.sha256(r.content).hexdigest() if ok else None, "" if ok else f"HTTP {r.status}"))
                except Exception as e:  # a failure is a row of the manifest, not the job's end
                    rows.append((id_, "failed", None, url, "", "", None, 0, None, f"{type(e).__name__}: {e}"[:300]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FETCHED.split(", ")]).astype({"http_status": "Int32"})

    hosts = work.select("id", direct_url(F.col("url")).alias("url")).withColumn("host", F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit("")))
    turn = F.row_number().over(Window.partitionBy("host").orderBy("id"))
    return hosts.repartition("host").withColumn("turn", turn).sortWithinPartitions("turn", "host").drop("turn").mapInPandas(run, FETCHED)


def direct_url(url):
    """A share link as the address of its file; other urls as they are."""
    shared = F.coalesce(url.contains("drive.google.com"), F.lit(False)) & drive_id(url).isNotNull()
    return F.when(shared, F.concat(F.lit("https://drive.usercontent.google.com/download?id="), drive_id(url), F.lit("&export=download&confirm=t"))).otherwise(url)
