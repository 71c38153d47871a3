"""Options of the jobs. Defaults are fixed values of the behaviour being matched."""

from __future__ import annotations

from dataclasses import dataclass

# Operating limits and names, compared with published defaults.
DEFAULT_INDEX_FORMAT = "logstash-{0:yyyy.MM.dd}"
DEFAULT_DEAD_LETTER_FORMAT = "deadletter-{0:yyyy.MM.dd}"
DEFAULT_TYPE_NAME = "logevent"
BATCH_POSTING_LIMIT = 50
PERIOD_SECONDS = 2
BUFFER_SHIPPING_SECONDS = 5
QUEUE_SIZE_LIMIT = 100_000
BUFFER_FILE_SIZE_LIMIT = 104_857_600
BUFFER_FILE_COUNT_LIMIT = 31
MINIMUM_BACKOFF_SECONDS = 5
MAXIMUM_BACKOFF_SECONDS = 600
EXCEPTION_DEPTH_LIMIT = 20
KEYWORD_LENGTH_LIMIT = 256


@dataclass(frozen=True)
class DocumentOptions:
    """Shape of the JSON document."""

    render_message: bool = True
    render_template: bool = True
    inline_fields: bool = False
    omit_enclosing_object: bool = False
    closing_delimiter: str = ""
    stack_trace_as_array: bool = False
    exceptions_as_object: bool = False


@dataclass(frozen=True)
class RouteOptions:
    """Target index, pipeline and what to do when the template is not registered."""

    index_format: str = DEFAULT_INDEX_FORMAT
    dead_letter_format: str = DEFAULT_DEAD_LETTER_FORMAT
    pipeline: str | None = None


@dataclass(frozen=True)
class BatchOptions:
    """Bulk batching; ``None`` lifts a limit."""

    op: str = "index"
    posting_limit: int = BATCH_POSTING_LIMIT
    queue_limit: int | None = QUEUE_SIZE_LIMIT
    event_bytes_limit: int | None = None

    def __post_init__(self) -> None:
        if self.op not in ("index", "create"):
            raise ValueError(f"op must be index or create, not {self.op!r}")
        if self.posting_limit < 1:
            raise ValueError("posting_limit must be at least 1")
        if self.queue_limit is not None and self.queue_limit < 1:
            raise ValueError("queue_limit must be positive, or None for no limit")


@dataclass(frozen=True)
class ShippingOptions:
    """Durable buffer and shipping."""

    rolling_interval: str = "Day"
    file_size_limit: int | None = BUFFER_FILE_SIZE_LIMIT
    file_count_limit: int | None = BUFFER_FILE_COUNT_LIMIT
    assume_bom: bool = True
    newline: str = "\n"
    period_seconds: float = BUFFER_SHIPPING_SECONDS
