"""How CSV text is written."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CsvDialect:
    """How the text is written.

    ``multiline``: True lets quoted fields hold line breaks, headers too, which makes each
    file a single task, however large it is; False splits files and takes each line as a
    record. The mode never follows from the size of the files.

    ``null_tokens``: further texts to be read as NULL in string columns.
    """

    pattern: str = "*.csv"
    multiline: bool = True
    quote: str = '"'
    escape: str = '"'
    encoding: str = "UTF-8"
    null_tokens: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.multiline not in (True, False):
            raise ValueError(f"unknown multiline {self.multiline!r}")
