"""Driver-side metadata: types from schemas, merged versions, the columns of a batch."""
