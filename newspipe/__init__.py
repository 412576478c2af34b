"""News collection on Spark: stored pages and landed API responses in, records out.

Every operator takes and returns DataFrames and uses native column expressions only,
so the same functions serve batch and streaming inputs.
"""

from .functions.charsets import page_text
from .functions.html import attribute, decode_entities, element_text, paragraphs
from .functions.urls import base_url, resolve_href
from .functions.values import join_list, json_text, label
from .operators.analyze import count_rows, counted, key_list, key_union, sample
from .operators.articles import extract_lenient, extract_rejects, extract_strict, judge_strict
from .operators.links import extract_links, resolve_links
from .operators.messages import (
    BATCH_QUERY,
    PUBLISH_QUERY,
    filter_news,
    from_wire,
    judged_wire,
    limit_messages,
    project_news,
    to_wire,
    wire_rejects,
)
from .operators.normalize import conform, fill_missing, flatten, flatten_raw
from .operators.ordered import first_rows
from .profiles import (
    CHILD_CHAIN,
    CLASS_TOKENS,
    LENIENT,
    STRICT,
    ChildChain,
    ClassTokens,
    LenientProfile,
    StrictProfile,
)
from .session import get_session, scratch_dir
from .sinks.csv import read_csv, stream_csv, write_csv, write_raw_csv
from .sinks.kafka import stream_kafka, write_kafka
from .sources.counter import counter_messages, counter_source, live_counter
from .sources.cursors import ordered_by_cursor
from .sources.kafka import read_kafka
from .sources.pages import add_section_urls, decoded_pages, scan_pages, section_urls
from .sources.responses import (
    collected_pages,
    explode_results,
    landed_items,
    landed_pages,
    read_api_pages,
)
from .streaming.appends import (
    Appender,
    Budget,
    append_csv_stream,
    append_table_stream,
    budgeted_stream,
    finish_budget,
)
from .streaming.ledger import Ledger
from .streaming.progress import Progress
from .streaming.runs import (
    RowsRead,
    every,
    finish,
    read_judged,
    rows_read,
    stream_judged,
    stream_parquet,
    stream_table,
)
