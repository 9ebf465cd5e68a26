"""The governance views, consumer queries and data-quality reports."""
