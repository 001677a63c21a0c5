"""The named queries over the library's operators."""
