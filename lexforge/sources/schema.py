"""Schemas of article records and derived tables."""

from __future__ import annotations

_NAMED = "array<struct<name:string,url:string>>"

#: One article record; keys not named here are ignored.
ARTICLE = (
    "identifier bigint, name string, url string, namespace struct<identifier:bigint>, version struct<identifier:bigint>, date_modified string, "
    f"article_body struct<html:string,wikitext:string>, redirects {_NAMED}, categories {_NAMED}, templates {_NAMED}, "
    "license array<struct<identifier:string,name:string,url:string>>, image struct<content_url:string,url:string,width:bigint,height:bigint>"
)

DIAGNOSTIC = "code string, severity string, stage string, page_id bigint, title string, message string, details_json string"

#: The document model, flattened: one row per block, in preorder.
BLOCK = "page_id bigint, node_id int, parent_id int, ordinal int, kind string, level int, anchor string, text string, attrs map<string,string>"

ENTRY = "tag string, title string, heading string, aliases array<string>, keywords array<string>, body string, targets array<string>"

LOCK = (
    "schema_version int, provider string, project string, namespace bigint, snapshot_identifier string, snapshot_version string, date_modified string, downloaded_at string, "
    "files array<struct<relative_path:string,chunk_identifier:string,size_bytes:bigint,sha256:string,media_type:string>>, supplements array<string>, "
    "metadata_response_sha256 string, acquirer struct<name:string,version:string,git_commit:string>"
)
