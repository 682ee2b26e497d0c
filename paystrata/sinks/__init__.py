"""Writers: bronze batches, message envelopes, reports and publish markers."""
