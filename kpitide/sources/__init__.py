"""Readers and writers: Kafka, files, sockets, the offset ledger, and the tables of this repository's queries."""
