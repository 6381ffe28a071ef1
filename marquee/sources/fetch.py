"""Fetching as a Spark data source: one partition per host, so a host is asked by one task at a time.

The fetcher is given by name as `module:function`, a callable (url, validator) -> (status, validator, body); nothing here opens a connection.
"""

from __future__ import annotations

import importlib
import json
import time
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "url string, host string, status int, validator string, body string, tries int, failed string"


class Host(InputPartition):
    def __init__(self, host: str, urls: list):
        self.host, self.urls = host, urls


class PageReader(DataSourceReader):
    """Options: fetcher, urls (JSON list of url or [url, validator]), pause and tries."""

    def __init__(self, options):
        self.fetcher = options["fetcher"]
        self.urls = [x if isinstance(x, list) else [x, None] for x in json.loads(options["urls"])]
        self.pause, self.tries = float(options.get("pause", 0)), int(options.get("tries", 3))

    def partitions(self):
        hosts: dict[str, list] = {}
        for url, validator in self.urls:
            hosts.setdefault(urlsplit(url).netloc.lower(), []).append((url, validator))
        return [Host(h, u) for h, u in sorted(hosts.items())] or [Host("", [])]

    def read(self, partition):
        module, name = self.fetcher.split(":")
        fetch = getattr(importlib.import_module(module), name)
        for i, (url, validator) in enumerate(partition.urls):
            if i and self.pause:
                time.sleep(self.pause)
            for n in range(1, self.tries + 1):
                try:
                    status, new, body = fetch(url, validator)
                    if status < 500 or n == self.tries:
                        yield url, partition.host, status, new, body, n, None
                        break
                except OSError as e:
                    if n == self.tries:
                        yield url, partition.host, None, validator, None, n, str(e)
                time.sleep(self.pause * 2**n)


class Pages(DataSource):
    @classmethod
    def name(cls):
        return "marquee_pages"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PageReader(self.options)
