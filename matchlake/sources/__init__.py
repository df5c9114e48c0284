"""Reading and writing feeds, and extraction from pages and payloads."""
