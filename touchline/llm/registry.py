"""Queries of this subpackage, by name."""

from __future__ import annotations

from touchline.llm.chat import SQL as CHAT_SQL
from touchline.llm.chat import chat
from touchline.llm.decontaminate import decontaminate
from touchline.llm.fingerprint import fingerprint
from touchline.llm.html_text import html_text
from touchline.llm.language import language
from touchline.llm.license_scan import license_scan
from touchline.llm.mixing import mixing
from touchline.llm.near_dedup import near_dedup
from touchline.llm.search import SQL as SEARCH_SQL
from touchline.llm.search import ranked_search
from touchline.llm.sharding import sharding
from touchline.llm.spelling import spelling
from touchline.llm.toxicity import toxicity
from touchline.llm.twins import DECONTAMINATE, NEAR_DEDUP
from touchline.llm.warc import SQL as WARC_SQL
from touchline.llm.warc import warc

QUERIES = {
    "op1_sharding": sharding,
    "op2_html_text": html_text,
    "op3_license_scan": license_scan,
    "op4_decontaminate": decontaminate,
    "op5_near_dedup": near_dedup,
    "op6_toxicity": toxicity,
    "op7_fingerprint": fingerprint,
    "op8_mixing": mixing,
    "op9_chat": chat,
    "op10_language": language,
    "op11_warc": warc,
    "op12_spelling": spelling,
    "op13_search": ranked_search,
}

ORACLE: dict[str, str] = {
    "op4_decontaminate": DECONTAMINATE,
    "op5_near_dedup": NEAR_DEDUP,
    "op9_chat": CHAT_SQL,
    "op11_warc": WARC_SQL,
    "op13_search": SEARCH_SQL,
}
