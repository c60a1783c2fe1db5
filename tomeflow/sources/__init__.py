"""Sources: file scans, format readers, encodings, settings and glossaries."""
