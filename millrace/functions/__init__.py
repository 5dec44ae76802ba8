"""Column functions: text, dates, numbers, JSON, XML, masking."""
