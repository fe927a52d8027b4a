"""Sources and sinks: file trees, keyed JSON tables, archives, release registries."""
