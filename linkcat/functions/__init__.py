"""Column expressions: media types, URLs, headers, text, versions, digests."""
