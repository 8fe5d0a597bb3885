"""Sinks for the cube, trend and report outputs."""

from .documents import (cube_document, cube_document_lines, cube_header, document_text, trend_document, write_cube,
                        write_document_lines, write_json_document)
from .publish import Publication, latest, manifests, read_published

__all__ = ["Publication", "cube_document", "cube_document_lines", "cube_header", "document_text", "latest", "manifests",
           "read_published", "trend_document", "write_cube", "write_document_lines", "write_json_document"]
