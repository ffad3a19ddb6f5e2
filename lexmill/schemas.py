"""Table schemas and closed value domains."""

from __future__ import annotations

# Document types and the life cycle of a document, in order.
DOCUMENT_TYPES = ["loi", "decret"]
STATUSES = [
    "PENDING",
    "FETCHED",
    "DOWNLOADED",
    "EXTRACTED",
    "CONSOLIDATED",
    "FAILED",
    "RATE_LIMITED",
]

# Severities, most severe first.
SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]

# Issue types and whether a repair exists for them.
ISSUE_TYPES = {
    "STUCK_IN_PENDING": True,
    "STUCK_IN_FETCHED": True,
    "STUCK_IN_DOWNLOADED": True,
    "STUCK_IN_EXTRACTED": True,
    "STATUS_INCONSISTENT": True,
    "MISSING_PDF": True,
    "MISSING_OCR": True,
    "MISSING_JSON": True,
    "CORRUPTED_PDF": False,
    "LOW_CONFIDENCE": True,
    "SEQUENCE_ISSUES": True,
    "HIGH_UNRECOGNIZED_WORDS": True,
    "CONSOLIDATION_FAILED": True,
    "MISSING_ARTICLES": True,
    "INCONSISTENT_DATA": True,
    "URL_NOT_FOUND_404": False,
    "DOWNLOAD_TIMEOUT": True,
}

# DDL text of every state table; keys are listed in KEYS.
TABLES = {
    "registry": "type string, year int, number int, url string, pdf_path string, ocr_path string, "
    "sha256 string, exists boolean, status string",
    "fetch_results": "document_id string, document_type string, year int, number int, url string, "
    "status string, exists boolean, fetched_at timestamp_ntz, error_message string",
    "cursors": "cursor_type string, document_type string, current_year int, current_number int, "
    "updated_at timestamp_ntz",
    "not_found": "document_type string, year int, number int, detected_at timestamp_ntz",
    "not_found_ranges": "document_type string, year int, number_min int, number_max int, "
    "document_count int, created_at timestamp_ntz, updated_at timestamp_ntz",
    "probe_results": "document_id string, attempt int, code int, padded boolean, ts timestamp_ntz",
    "inventory": "document_id string, kind string, length long",
    "download_results": "document_id string, url string, pdf_path string, sha256 string, "
    "file_size long, downloaded_at timestamp_ntz, error_message string",
    "texts": "document_id string, type string, text string",
    "payloads": "document_id string, content binary",
    "extractions": "document_id string, json string, confidence double, source string",
    "consolidated_metadata": "document_id string, document_type string, document_year int, "
    "document_number int, title string, promulgation_date string, promulgation_city string, "
    "total_articles int, source_url string, extraction_confidence double, "
    "extraction_method string, extraction_timestamp string, consolidated_at timestamp_ntz",
    "consolidated_articles": "document_id string, article_index int, content string, "
    "document_type string, document_year int, document_number int, "
    "extraction_confidence double, extraction_method string, consolidated_at timestamp_ntz",
    "consolidated_signatories": "document_id string, signatory_order int, role string, "
    "name string, mandate_start date, mandate_end date, document_type string, "
    "document_year int, consolidated_at timestamp_ntz",
    "unrecognized_words": "word string",
    "daily_runs": "job string, day string",
    "cycle_steps": "version long, step string",
    "fix_results": "document_id string, position int, issue_type string, severity string, "
    "fix_status string, status_before string, status_after string",
}

KEYS = {
    "registry": ["type", "year", "number"],
    "fetch_results": ["document_id"],
    "cursors": ["cursor_type", "document_type"],
    "not_found": ["document_type", "year", "number"],
    "not_found_ranges": ["document_type", "year", "number_min", "number_max"],
    "download_results": ["document_id"],
    "texts": ["document_id"],
    "payloads": ["document_id"],
    "extractions": ["document_id"],
    "consolidated_metadata": ["document_id"],
    "consolidated_articles": ["document_id", "article_index"],
    "consolidated_signatories": ["document_id", "signatory_order"],
    "unrecognized_words": ["word"],
    "daily_runs": ["job", "day"],
}

# How state tables are partitioned. Extractions and downloads have the two only in the id.
PARTITIONS = {
    "registry": ("type", "year"),
    "fetch_results": ("document_type", "year"),
    "not_found": ("document_type", "year"),
    "not_found_ranges": ("document_type", "year"),
    "download_results": ("type", "year"),
    "extractions": ("type", "year"),
    "consolidated_metadata": ("document_type", "document_year"),
    "consolidated_articles": ("document_type", "document_year"),
    "consolidated_signatories": ("document_type", "document_year"),
}

# One extraction document. The reader accepts three dialects (see functions.jsondoc.normalize):
# programmatic keys, older samples, and French keys.
DOCUMENT_JSON = (
    "_metadata struct<confidence:double,source:string,timestamp:string>, documentId string, "
    "type string, year int, number int, title string, promulgationDate string, "
    "promulgationCity string, articles array<struct<index:int,content:string>>, "
    "signatories array<struct<name:string,role:string,order:int,mandateStart:string,"
    "mandateEnd:string>>"
)

DIALECT_JSON = (
    "_metadata struct<confidence:double,source:string,method:string,timestamp:string>, "
    "documentId string, type string, year int, annee int, number int, numero string, "
    "title string, titre string, promulgationDate string, datePromulgation string, "
    "promulgationCity string, "
    "articles array<struct<index:string,number:string,numero:string,content:string,"
    "contenu:string>>, "
    "signatories array<struct<name:string,role:string,title:string,order:int,"
    "mandateStart:string,mandateEnd:string>>, "
    "signataires array<struct<nom:string,titre:string,fonction:string>>"
)


def empty(spark, table: str):
    """An empty state table with its schema."""
    return spark.createDataFrame([], TABLES[table])
