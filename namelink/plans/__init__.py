"""The end-user jobs: index builds, searches, deduplication."""
