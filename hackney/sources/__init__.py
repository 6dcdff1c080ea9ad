"""Reading and writing the zones of the lake and the published table."""
