"""Services for tests: they fail where a test wants it, and remember in a folder how often they were asked."""

from pathlib import Path

from millrace.sinks.two_phase import FolderArchive
from millrace.sources.paged import Walk


def count(folder, name):
    """How often this was called for ``name``, this time included."""
    at = Path(folder) / f"asked-{name}"
    at.parent.mkdir(parents=True, exist_ok=True)
    with open(at, "a") as f:
        f.write("x")
    return at.stat().st_size


class FlakyPages:
    """Tables ``a`` (10 pages of 2, in two walks) and ``b`` (one page), each page refused the first time; ``c`` goes round in circles."""

    def __init__(self, options):
        self.folder, self.refuse = options["folder"], int(options.get("refuse", 1))

    def walks(self):
        return [Walk("a", None, "5"), Walk("a", "5"), Walk("b"), Walk("c")]

    def page(self, table, cursor):
        if count(self.folder, f"{table}-{cursor}") <= self.refuse:
            raise ConnectionError(cursor)
        n = int(cursor or 0)
        if table == "c":
            return {"results": [], "has_more": True, "next_cursor": "1"}
        last = n == 9 or table == "b"
        return {"results": [{"n": n, "i": i} for i in range(2)], "has_more": not last, "next_cursor": None if last else str(n + 1)}


class FlakyArchive(FolderArchive):
    """The first attempt to stage a batch that holds id ``x7`` dies half way."""

    def __init__(self, options):
        super().__init__(options)
        self.folder, self.refuse = options["path"], int(options.get("refuse", 1))

    def stage(self, run, rows):
        def some():
            for row in rows:
                if row["id"] == "x7" and count(self.folder, "x7") <= self.refuse:
                    raise ConnectionError("x7")
                yield row

        return super().stage(run, some())
