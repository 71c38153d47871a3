"""Row shapes shared by the jobs."""

from __future__ import annotations

# An event: when, how severe, what it says, what it carries (properties as JSON text by name).
EVENT_COLUMNS = {
    "event_id": "bigint",
    "ts": "timestamp",
    "offset_minutes": "int",
    "level": "string",
    "message_template": "string",
    "properties": "map<string,string>",
    "exceptions": "array<struct<ClassName:string,Message:string,Source:string,StackTraceString:string,"
    "RemoteStackTraceString:string,RemoteStackIndex:int,ExceptionMethod:string,HResult:int,HelpURL:string>>",
}

# The shape of a flattened exception in a document.
EXCEPTION = (
    "struct<Depth:int,ClassName:string,Message:string,Source:string,StackTraceString:string,"
    "RemoteStackTraceString:string,RemoteStackIndex:int,"
    "ExceptionMethod:struct<Name:string,AssemblyName:string,AssemblyVersion:string,AssemblyCulture:string,"
    "ClassName:string,Signature:string,MemberType:int>,HResult:int,HelpURL:string>"
)

# A bulk response.
ITEM = "struct<_index:string,_id:string,status:int,error:struct<type:string,reason:string>>"
RESPONSE_BODY = f"struct<errors:boolean,items:array<struct<index:{ITEM},create:{ITEM}>>>"

# Explicit types of a read-back document.
DOCUMENT = (
    "struct<`@timestamp`:timestamp,level:string,messageTemplate:string,message:string,"
    f"exceptions:array<{EXCEPTION}>>"
)
