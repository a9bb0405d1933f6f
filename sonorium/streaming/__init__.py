"""Progress of a resumable job as a log that is only appended to."""
