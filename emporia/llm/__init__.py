"""Operators of a large-scale training-data pipeline: dedup, language and
quality filters, tokenizer work, WARC archives, packing, licence scans."""
